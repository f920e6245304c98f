"""Click ingest from text objects with a ledger of the objects that were taken.

The ledger is a Parquet table of (key, size, modified, batch), partitioned by the objects' day folder. A
run lists the last day folders only, anti-joins the listing with the ledger's partitions of those days
and reads what is left, so neither the driver's state nor the listing grows with the history. An object
that comes late, or again with other contents, is taken by the next run that lists its folder.

`ingest_click_days` does the same with Structured Streaming: every day folder is a stream of its own with a
checkpoint of its own, so a source path never changes under a checkpoint and a day's list of seen files
is as long as the day.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from datetime import date
from itertools import islice

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..plans.clicks import click_rows
from ..sinks.upsert import insert_clicks
from ..sources.objects import DAYS, day_folders, day_objects, line_columns, literal_path
from .clicks import ingest_clicks, stream_click_lines

OBJECT = ("key", "size", "modified")
LEDGER = "key STRING, size BIGINT, modified TIMESTAMP_NTZ, batch STRING, day STRING"
#: Object names that pass through the driver at a time, and objects that one insert reads.
OBJECTS_PER_BATCH = 10_000


def ledger_rows(spark: SparkSession, ledger: str, days: list[str] | None = None) -> DataFrame:
    """The ledger, or its partitions of some days (YYYY-MM-DD); empty before the first run."""
    try:
        rows = spark.read.schema(LEDGER).parquet(ledger)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        rows = spark.createDataFrame([], LEDGER)
    return rows if days is None else rows.where(F.col("day").isin(days))


def new_objects(
    spark: SparkSession,
    base: str,
    today: date,
    ledger: str,
    days: int = DAYS,
    name_part: str = "clicks",
) -> DataFrame:
    """(path, key, size, modified, day) of the objects of the last day folders that the ledger does not have.

    Key, size and modification time are compared: an object that was written anew is new.
    """
    listed = day_objects(spark, base, today, days, name_part)
    known = ledger_rows(spark, ledger, [d.replace("/", "-") for d in day_folders(today, days)])
    return listed.join(known.select(*OBJECT), list(OBJECT), "left_anti")


def _chunks(rows: Iterator[Row], size: int) -> Iterator[list[Row]]:
    while part := list(islice(rows, size)):
        yield part


def ingest_new_objects(
    spark: SparkSession,
    base: str,
    today: date,
    target: str,
    ledger: str,
    days: int = DAYS,
    name_part: str = "clicks",
    objects_per_batch: int = OBJECTS_PER_BATCH,
    table: str | None = None,
    buckets: int | None = None,
) -> int:
    """Insert the clicks of the objects that are not in the ledger and enter these; returns their number.

    Objects are taken oldest first, `objects_per_batch` at a time, and entered after their clicks are stored.
    A run that fails in between takes the batch again, and the insert by key leaves out what is stored.
    """
    waiting = new_objects(spark, base, today, ledger, days, name_part).orderBy("modified", "key")
    taken = 0
    for part in _chunks(waiting.toLocalIterator(prefetchPartitions=True), objects_per_batch):
        lines = spark.read.text([literal_path(r["path"]) for r in part]).select(*line_columns(base))
        insert_clicks(click_rows(lines), target, table, buckets)
        entry = spark.createDataFrame(part, waiting.schema).select(*OBJECT, F.lit(uuid.uuid4().hex).alias("batch"), "day")
        entry.coalesce(1).write.mode("append").partitionBy("day").parquet(ledger)
        taken += len(part)
    return taken


def ingest_click_days(
    spark: SparkSession,
    base: str,
    target: str,
    checkpoints: str,
    today: date,
    days: int = DAYS,
    table: str | None = None,
    buckets: int | None = None,
) -> list[str]:
    """Stream what is new in each of the last day folders, oldest first; returns the folders.

    Every folder has its checkpoint below `checkpoints`; one whose day is no longer listed may be removed.
    """
    folders = day_folders(today, days)[::-1]
    for folder in folders:
        lines = stream_click_lines(spark, base, folder=folder)
        state = f"{checkpoints.rstrip('/')}/{folder.replace('/', '-')}"
        ingest_clicks(click_rows(lines), target, state, table, buckets).awaitTermination()
    return folders
