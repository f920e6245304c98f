"""Parquet outputs: full snapshots and partition refresh, with a manifest of what was written."""

from __future__ import annotations

import time
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .staged import replace_folder

COMPRESSION = "gzip"


def dataset_path(base: str, name: str) -> str:
    """Where a data set lives below a base."""
    return f"{base.rstrip('/')}/{name}"


def row_count(spark: SparkSession, path: str) -> int:
    """Rows of a Parquet data set; no column is read, the counts come from the footers."""
    return spark.read.parquet(path).count()


def file_sizes(
    spark: SparkSession, path: str, group: Sequence[str] = (), where: Column | None = None
) -> DataFrame:
    """Files, rows and bytes of a Parquet data set, by partition columns if any are named.

    Only file metadata and row counts are read. `where` may name partition columns; partitions it
    leaves out are not listed.
    """
    data = spark.read.parquet(path)
    if where is not None:
        data = data.where(where)
    per_file = (
        data.groupBy(
            *[F.col(c).cast("string").alias(c) for c in group],
            F.col("_metadata.file_path").alias("file"),
        )
        .agg(F.count(F.lit(1)).alias("rows"), F.max("_metadata.file_size").alias("size"))
    )
    return per_file.groupBy(*group).agg(
        F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"), F.sum("size").alias("bytes")
    )


def write_snapshot(frame: DataFrame, path: str) -> DataFrame:
    """Replace a data set and return its manifest row.

    The rows are written aside and counted before the old ones go, so a run that fails leaves the old
    data set as it was; the frame may read the data set it replaces.
    """
    started = time.monotonic()
    replace_folder(frame, path, COMPRESSION)
    return manifest_row(frame.sparkSession, path, started)


def manifest_row(spark: SparkSession, path: str, started: float) -> DataFrame:
    """The manifest row of a data set whose writing began at `started` (monotonic seconds)."""
    elapsed = int((time.monotonic() - started) * 1000)
    written = file_sizes(spark, path)
    entry = written.select(
        F.lit(path).alias("path"),
        F.lit(None).cast("string").alias("window_start"),
        "files",
        F.coalesce("rows", F.lit(0)).alias("rows"),
        F.coalesce("bytes", F.lit(0)).alias("bytes"),
        F.lit(elapsed).cast("bigint").alias("elapsed_ms"),
    )
    return _settled(entry)


def _settled(manifest: DataFrame) -> DataFrame:
    """A manifest as it is now, one row per output written; later writes do not change it."""
    return manifest.sparkSession.createDataFrame(manifest.collect(), manifest.schema)


def refresh_partitions(
    frame: DataFrame,
    path: str,
    partition_by: Sequence[str],
    windows: Iterable[Mapping[str, object]],
) -> DataFrame:
    """Replace the listed partitions of a data set and return one manifest row per partition.

    `windows` lists the partition values to rebuild, a few rows by construction. A row of any other
    partition fails the job before anything is committed. All of them are written by one job with dynamic overwrite, so other
    partitions stay. Rows are rebalanced by partition value before the write: AQE splits a large
    partition over several tasks and merges small ones. The same job notes which windows had no
    rows; those are written as an empty file, so that a stale partition is replaced as well.
    """
    spark = frame.sparkSession
    windows = [{c: str(w[c]) for c in partition_by} for w in windows]
    seen = Observation()
    listed_row = reduce(lambda a, b: a | b, map(_in_window, windows), F.lit(False))
    place = F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in partition_by])
    stray = F.raise_error(F.concat(F.lit("row outside the listed partitions: "), place))
    guarded = frame.where(F.when(listed_row, F.lit(True)).otherwise(stray.cast("boolean")))
    observed = guarded.observe(
        seen,
        *[F.count_if(_in_window(w)).alias(f"w{i}") for i, w in enumerate(windows)],
    )
    started = time.monotonic()
    (
        observed.hint("rebalance", *[F.col(c) for c in partition_by])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", COMPRESSION)
        .partitionBy(*partition_by)
        .parquet(path)
    )
    elapsed = int((time.monotonic() - started) * 1000)

    body = spark.createDataFrame([], frame.drop(*partition_by).schema)
    for window, rows in zip(windows, _rows_per_window(frame, seen, windows)):
        if rows == 0:
            folder = "/".join(f"{c}={window[c]}" for c in partition_by)
            body.coalesce(1).write.mode("overwrite").option("compression", COMPRESSION).parquet(
                f"{path}/{folder}"
            )

    counted = file_sizes(
        spark, path, partition_by, where=reduce(lambda a, b: a | b, map(_in_window, windows))
    )
    listed = spark.createDataFrame(
        [tuple(w.values()) for w in windows], ", ".join(f"{c} STRING" for c in partition_by)
    )
    label = F.concat_ws("/", *[F.concat(F.lit(f"{c}="), F.col(c)) for c in partition_by])
    manifest = listed.join(counted, list(partition_by), "left").select(
        F.concat(F.lit(path + "/"), label).alias("path"),
        label.alias("window_start"),
        F.coalesce("files", F.lit(0)).alias("files"),
        F.coalesce("rows", F.lit(0)).alias("rows"),
        F.coalesce("bytes", F.lit(0)).alias("bytes"),
        F.lit(elapsed).cast("bigint").alias("elapsed_ms"),
    )
    return _settled(manifest)


def _rows_per_window(
    frame: DataFrame, seen: Observation, windows: Sequence[Mapping[str, str]]
) -> list[int]:
    """Observed rows of each window. A frame found empty while running has no metrics; it is counted."""
    names = [f"w{i}" for i in range(len(windows))]
    try:
        found = seen.get
    except Py4JJavaError:
        counts = [F.count_if(_in_window(w)).alias(n) for n, w in zip(names, windows)]
        found = frame.agg(*counts).first().asDict()
    return [found[n] for n in names]


def _in_window(window: Mapping[str, str]) -> Column:
    return reduce(
        lambda a, b: a & b, [F.col(c).cast("string") == v for c, v in window.items()]
    )


def manifest_totals(manifest: DataFrame) -> DataFrame:
    """Totals of a run over its manifest."""
    return manifest.agg(
        F.count(F.lit(1)).alias("outputs"),
        F.sum("rows").alias("rows"),
        F.sum("bytes").alias("bytes"),
        F.sum("elapsed_ms").alias("elapsed_ms"),
    )
