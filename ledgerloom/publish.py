"""Write outputs by name and keep the manifest of the run."""

from __future__ import annotations

import time
from collections.abc import Iterable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.lookup import planned_bytes
from .plans.catalogue import OUTPUTS, WINDOWED, build
from .session import widened_shuffles
from .sinks.catalog import register
from .sinks.parquet import dataset_path, manifest_row, refresh_partitions, write_snapshot
from .sinks.upsert import ingest_recent_clicks, write_boosted
from .sources.tables import read_table


def publish(
    spark: SparkSession, name: str, base: str, out: str, database: str | None = None
) -> DataFrame:
    """Refresh one full output; returns its manifest row. With a `database` it is registered there."""
    path, read = dataset_path(out, name), [read_table(spark, base, t) for t in OUTPUTS[name].tables]
    with widened_shuffles(spark, sum(map(planned_bytes, read))):
        frame = build(spark, name, base)
        written = write_snapshot(frame, path)
    if database is not None:
        register(spark, f"{database}.{name}", path, frame.schema)
    return written.select(F.lit(name).alias("name"), "*")


def publish_windows(
    spark: SparkSession, name: str, base: str, out: str, today: date, database: str | None = None
) -> DataFrame:
    """Refresh the windows of a partitioned output for a day; returns one manifest row per window.

    With a `database` the output is registered there, new partitions included.
    """
    spec = WINDOWED[name]
    source = read_table(spark, base, spec.table)
    path = dataset_path(out, name)
    with widened_shuffles(spark, planned_bytes(source)):
        rows, windows = spec.plan(spark, source, today)
        written = refresh_partitions(rows, path, spec.partition_by, windows)
    if database is not None:
        register(spark, f"{database}.{name}", path, rows.schema, spec.partition_by, windows)
    return written.select(F.lit(name).alias("name"), "*")


def publish_boosted(
    spark: SparkSession,
    scores: DataFrame,
    base: str,
    out: str,
    version: str,
    database: str | None = None,
) -> DataFrame:
    """Write the configurations with new booster values as a version; returns its manifest row.

    With a `database` the table `wpcs` there is pointed at the new version.
    """
    wpcs = read_table(spark, base, "wpcs")
    table = None if database is None else f"{database}.wpcs"
    started = time.monotonic()
    with widened_shuffles(spark, planned_bytes(wpcs)):
        path = write_boosted(wpcs, scores, dataset_path(out, "wpcs"), version, table)
    return manifest_row(spark, path, started).select(F.lit("wpcs").alias("name"), "*")


def publish_clicks(
    spark: SparkSession,
    objects: str,
    out: str,
    today: date,
    table: str | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Insert the clicks of the last day folders that are not stored yet; returns the store's manifest row."""
    path = dataset_path(out, "ads_clicks")
    started = time.monotonic()
    ingest_recent_clicks(spark, objects, today, path, table, buckets)
    return manifest_row(spark, path, started).select(F.lit("ads_clicks").alias("name"), "*")


def publish_all(
    spark: SparkSession,
    base: str,
    out: str,
    names: Iterable[str] = tuple(OUTPUTS),
    database: str | None = None,
) -> tuple[DataFrame, dict[str, str]]:
    """Refresh several outputs; one that fails does not stop the others.

    Returns the manifest of those written and the errors of the rest by name.
    """
    written, errors = [], {}
    for name in names:
        try:
            written.append(publish(spark, name, base, out, database))
        except Exception as error:  # a broken contract or a missing source, kept for the caller
            errors[name] = str(error)
    if not written:
        raise RuntimeError(f"no output was written: {errors}")
    return reduce(DataFrame.unionByName, written), errors
