"""Data sets kept as versions, each a list of Parquet files.

A change writes the files it touches anew and lists the others again, so its cost is that of the touched
files. Below the data set's folder lie `files/` (data, a folder per write), `lists/` (the files of each
version) and `versions/` (a row per version). A version exists from the moment its row is appended, which
is one small file; everything before can fail without a reader noticing.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources.objects import literal_path
from .parquet import COMPRESSION
from .staged import IncompleteWrite, write_verified

VERSION = "version BIGINT, id STRING, parent STRING, files BIGINT, rows BIGINT, bytes BIGINT"


class ConcurrentWrite(RuntimeError):
    """Another version was made from the same parent at the same time and came first."""


def versions(spark: SparkSession, path: str) -> DataFrame:
    """The versions of a data set; of several with one number that of smallest id counts."""
    try:
        rows = spark.read.schema(VERSION).json(f"{path}/versions")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], VERSION)
    first = rows.groupBy("version").agg(F.min_by(F.struct(*rows.columns), "id").alias("v"))
    return first.select("v.*")


def current(spark: SparkSession, path: str, version: int | None = None) -> Row | None:
    """The row of a version, the latest if none is named; None where there is none."""
    rows = versions(spark, path)
    rows = rows if version is None else rows.where(F.col("version") == version)
    return rows.orderBy(F.desc("version")).first()


def version_files(spark: SparkSession, path: str, version: Row) -> DataFrame:
    """(file, rows, bytes) of a version."""
    return spark.read.parquet(f"{path}/lists/{version['id']}")


def _read(spark: SparkSession, schema: StructType, files: DataFrame) -> DataFrame:
    """The rows of listed files. Their names pass through the driver, as those of any scan do."""
    names = files.select(F.url_decode(F.regexp_replace("file", r"\+", "%2B")).alias("f")).collect()
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[literal_path(r["f"]) for r in names])


def read_version(spark: SparkSession, path: str, schema: StructType, version: int | None = None) -> DataFrame:
    """The rows of a version, the latest if none is named."""
    row = current(spark, path, version)
    if row is None:
        raise FileNotFoundError(f"{path} has no version" + ("" if version is None else f" {version}"))
    return _read(spark, schema, version_files(spark, path, row))


def _written(spark: SparkSession, folder: str) -> DataFrame:
    """(file, rows, bytes) of the files in a folder, from their footers."""
    data = spark.read.parquet(folder)
    return data.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("rows"), F.max("_metadata.file_size").alias("bytes")
    )


def _commit(spark: SparkSession, path: str, mark: str, parent: Row | None) -> Row:
    """Append the row of the version whose list has been written."""
    totals = spark.read.parquet(f"{path}/lists/{mark}").agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")
    ).first()
    number = 1 if parent is None else parent["version"] + 1
    row = (number, mark, None if parent is None else parent["id"], *totals)
    spark.createDataFrame([row], VERSION).coalesce(1).write.mode("append").json(f"{path}/versions")
    made = current(spark, path, number)
    if made["id"] != mark:
        raise ConcurrentWrite(f"version {number} of {path} was made by another run")
    return made


def write_full(frame: DataFrame, path: str) -> Row:
    """A version of all rows of a frame; returns its row."""
    spark, mark = frame.sparkSession, uuid.uuid4().hex
    parent = current(spark, path)
    write_verified(frame, f"{path}/files/{mark}", COMPRESSION)
    _written(spark, f"{path}/files/{mark}").coalesce(1).write.parquet(f"{path}/lists/{mark}")
    return _commit(spark, path, mark, parent)


def rewrite_files(
    spark: SparkSession,
    path: str,
    schema: StructType,
    touched: Callable[[DataFrame], DataFrame],
    change: Callable[[DataFrame], DataFrame],
) -> Row:
    """A version in which only the files that hold touched rows are new; returns its row.

    `touched` picks the rows that change; only the columns it uses are read. `change` maps the rows of
    whole files to as many rows of the same columns. The other files are listed again as they are. Without a touched row
    the current version is returned.
    """
    parent, mark = current(spark, path), uuid.uuid4().hex
    if parent is None:
        raise FileNotFoundError(f"{path} has no version")
    listed = version_files(spark, path, parent)
    rows = _read(spark, schema, listed).select("*", F.col("_metadata.file_path").alias("_file"))
    changed = [r["_file"] for r in touched(rows).select("_file").distinct().collect()]
    if not changed:
        return parent
    names = spark.createDataFrame([(f,) for f in changed], "file string")
    old = listed.join(names, "file", "left_semi")
    before = old.agg(F.sum("rows")).first()[0]
    fresh = change(_read(spark, schema, old)).select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
    after = write_verified(fresh, f"{path}/files/{mark}", COMPRESSION)
    if before != after:
        raise IncompleteWrite(f"{before} rows of {path} became {after}")
    kept = listed.join(names, "file", "left_anti")
    kept.unionByName(_written(spark, f"{path}/files/{mark}")).coalesce(1).write.parquet(f"{path}/lists/{mark}")
    return _commit(spark, path, mark, parent)
