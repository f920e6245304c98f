"""Insert-if-absent for clicks and versioned write-back for scores."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.lookup import DEFAULT_POLICY, SkewPolicy, is_small
from ..plans.boost import boosted, changed_rows
from ..plans.clicks import KEY, click_rows, unseen_clicks, unseen_clicks_by_bucket
from ..schemas import table_schema
from ..sources.objects import read_click_lines
from .catalog import register
from .parquet import COMPRESSION
from .versions import rewrite_files


def stored_clicks(spark: SparkSession, path: str) -> DataFrame:
    """The stored click table; empty when nothing has been written yet."""
    schema = table_schema("clicks")
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], schema)


def _years(clicks: DataFrame, years: Sequence[int] | None) -> list[int]:
    """Calendar years of the rows, read from them when the caller does not know them."""
    if years is None:
        years = [r["year"] for r in clicks.select("year").distinct().collect()]
    return sorted(years)


def insert_new_clicks(clicks: DataFrame, path: str, years: Sequence[int] | None = None) -> None:
    """Append the clicks whose (id, year) is not stored, partitioned by year.

    Running it again with the same rows appends nothing, also when an earlier run failed half-way.
    Only the stored years of the new rows are compared, and only their keys are read. Where Catalyst
    estimates the new keys below the broadcast threshold, they go to the stored ones and only those that
    are found again move. Otherwise the keys of a year are moved for the comparison; where that is too
    much, keep the table bucketed (see create_click_table).
    """
    spark = clicks.sparkSession
    years = _years(clicks, years)
    if not years:
        return
    history = stored_clicks(spark, path).where(F.col("year").isin(*years))
    history = repeated_keys(clicks, history)
    (
        unseen_clicks(clicks, history)
        .hint("rebalance", F.col("year"))
        .write.mode("append")
        .option("compression", COMPRESSION)
        .partitionBy("year")
        .parquet(path)
    )


def repeated_keys(
    clicks: DataFrame, history: DataFrame, policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """The stored keys that the new rows may repeat: those they do where the new keys are small, else all."""
    stored, new = history.select(*KEY), clicks.select(*KEY)
    if not is_small(new, policy):
        return stored
    return stored.join(new, list(KEY), "left_semi")


def create_click_table(spark: SparkSession, table: str, path: str, buckets: int) -> None:
    """A catalog table of clicks, partitioned by year and bucketed by id."""
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in table_schema("clicks").fields
    )
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet"
        f" OPTIONS (compression '{COMPRESSION}') PARTITIONED BY (year)"
        f" CLUSTERED BY (id) INTO {buckets} BUCKETS LOCATION '{path}'"
    )


def insert_new_clicks_into(
    clicks: DataFrame, table: str, buckets: int, years: Sequence[int] | None = None
) -> None:
    """The same for a bucketed table: stored keys are compared where they lie, only new rows move."""
    spark = clicks.sparkSession
    years = _years(clicks, years)
    if not years:
        return
    history = spark.table(table).where(F.col("year").isin(*years))
    columns = table_schema("clicks").names
    fresh = unseen_clicks_by_bucket(clicks, history, buckets)
    fresh.select(*columns).write.insertInto(table)


def insert_clicks(
    clicks: DataFrame, path: str, table: str | None = None, buckets: int | None = None
) -> None:
    """Insert into a bucketed catalog table, made at the path if it is new, or else into the path alone.

    With the table a batch moves its own rows only, however long the stored history is.
    """
    if table is None:
        insert_new_clicks(clicks, path)
        return
    if buckets is None:
        raise ValueError("a bucketed click table needs its number of buckets")
    create_click_table(clicks.sparkSession, table, path, buckets)
    insert_new_clicks_into(clicks, table, buckets)


def ingest_recent_clicks(
    spark: SparkSession,
    base: str,
    today: date,
    path: str,
    table: str | None = None,
    buckets: int | None = None,
) -> None:
    """Insert the clicks of the last day folders; the years compared are those of the rows read."""
    insert_clicks(click_rows(read_click_lines(spark, base, today)), path, table, buckets)


def write_boosted(
    wpcs: DataFrame, scores: DataFrame, base: str, version: str, table: str | None = None
) -> str:
    """Write the updated configurations as a new version and return its path.

    A table that is being read is never overwritten. With a `table` the new version is registered
    under that name once it is complete; without, the caller points readers at it.
    """
    path = f"{base.rstrip('/')}/version={version}"
    rows = boosted(wpcs, scores)
    rows.write.mode("errorifexists").option("compression", COMPRESSION).parquet(path)
    if table is not None:
        register(wpcs.sparkSession, table, path, rows.schema)
    return path


def boost_files(
    spark: SparkSession, scores: DataFrame, path: str, schema: StructType | None = None
) -> Row:
    """Write the scores into a versioned table of configurations: only files with a changed row are new.

    Files are found by the key and the booster of their rows; the others become part of the new version as
    they are. Scores that change nothing make no version. `schema` is that of the table if it is not
    the declared one. Returns the row of the current version.
    """
    return rewrite_files(
        spark,
        path,
        schema or table_schema("wpcs"),
        lambda rows: changed_rows(rows, scores),
        lambda rows: boosted(rows, scores),
    )
