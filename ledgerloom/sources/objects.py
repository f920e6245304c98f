"""Objects under dated prefixes: gzip JSON lines of clicks, and listings."""

from __future__ import annotations

import re
from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LINE_SCHEMA = "value STRING, file_name STRING, last_modified_date TIMESTAMP_NTZ"
DAYS = 5
# Scheme and host of a path.
SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"


def day_folders(today: date, days: int = DAYS) -> list[str]:
    """The day's folder and those of the days before, newest first, as YYYY/MM/DD."""
    return [(today - timedelta(days=back)).strftime("%Y/%m/%d") for back in range(days)]


def _object_key(base: str):
    """Path of a file below the base, from the file metadata of a scan."""
    # File paths are URIs: decoded once, and compared without scheme and host.
    uri = F.regexp_replace(F.col("_metadata.file_path"), r"\+", "%2B")
    path = F.regexp_replace(F.url_decode(uri), SCHEME, "")
    root = re.sub(r"/{2,}", "/", re.sub(SCHEME, "", base))
    if not root.startswith("/"):
        below = F.locate("/" + root, path)
        root = "/" + root
    else:
        below = F.when(path.startswith(root), F.lit(1)).otherwise(F.lit(0))
    outside = F.raise_error(F.concat(path, F.lit(f" is not below {root}")))
    return F.when(below > 0, path.substr(below + F.lit(len(root)), F.length(path))).otherwise(outside)


def _utc(column: str):
    """UTC wall-clock time of a timestamp, whatever the zone of the session."""
    return F.to_utc_timestamp(F.col(column), F.current_timezone()).cast("timestamp_ntz")


def line_columns(base: str):
    """Line text with the object key and the modification time of its file."""
    base = base.rstrip("/") + "/"
    return [
        F.col("value"),
        _object_key(base).alias("file_name"),
        _utc("_metadata.file_modification_time").alias("last_modified_date"),
    ]


def _recent(spark: SparkSession, base: str, today: date, days: int, file_format: str) -> DataFrame | None:
    """A scan of the last day folders, or None when none of them exists."""
    folders = ",".join(day_folders(today, days))
    reader = spark.read.format(file_format).option("recursiveFileLookup", "true")
    try:
        return reader.load(f"{base.rstrip('/')}/{{{folders}}}*")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return None


def read_click_lines(
    spark: SparkSession, base: str, today: date, days: int = DAYS, name_part: str = "clicks"
) -> DataFrame:
    """Lines of the click objects of the last days; `.gz` is decoded by its extension.

    The name filter looks at the whole key, folders included. It is a file metadata filter, so the
    files that do not match are dropped before they are read. Missing folders give no rows.
    """
    lines = _recent(spark, base, today, days, "text")
    if lines is None:
        return spark.createDataFrame([], LINE_SCHEMA)
    return lines.select(*line_columns(base)).where(F.col("file_name").contains(name_part))


def click_object_years(
    spark: SparkSession, base: str, today: date, days: int = DAYS
) -> DataFrame:
    """Distinct modification years of the objects of the last days; contents are not read."""
    files = _recent(spark, base, today, days, "binaryFile")
    if files is None:
        return spark.createDataFrame([], "year INT")
    return files.select(F.year(_utc("modificationTime")).alias("year")).distinct()


def literal_path(path: str) -> str:
    """A path whose name holds no pattern for the reader."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def day_objects(
    spark: SparkSession, base: str, today: date, days: int = DAYS, name_part: str = "clicks"
) -> DataFrame:
    """(path, key, size, modified, day) of the objects of the last day folders; contents are not read."""
    files = _recent(spark, base, today, days, "binaryFile")
    if files is None:
        return spark.createDataFrame([], "path STRING, key STRING, size BIGINT, modified TIMESTAMP_NTZ, day STRING")
    listed = files.select(
        "path",
        _object_key(base.rstrip("/") + "/").alias("key"),
        F.col("length").alias("size"),
        _utc("modificationTime").alias("modified"),
    )
    day = F.regexp_replace(F.substring("key", 1, len("YYYY/MM/DD")), "/", "-")
    return listed.where(F.col("key").contains(name_part)).withColumn("day", day)


def list_objects(spark: SparkSession, base: str, pattern: str = "*") -> DataFrame:
    """Path, modification time and size of the files under a prefix; contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(base)
    )
    return files.select("path", "modificationTime", "length")
