"""Click ingest as a stream of files.

The file source remembers the files it has read in its checkpoint, so a run picks up what is new and
stops. Rows are inserted by key inside foreachBatch, which makes a repeated batch harmless.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.clicks import KEY, click_rows
from ..sinks.upsert import insert_clicks
from ..sources.objects import DAYS, day_folders, line_columns

LATENESS = "5 days"
# Spark leaves out files older than 7 days by default.
MAX_AGE = "36500d"


def stream_click_lines(
    spark: SparkSession,
    base: str,
    name_part: str = "clicks",
    files_per_batch: int = 10_000,
    today: date | None = None,
    days: int = DAYS,
    max_age: str = MAX_AGE,
    folder: str | None = None,
) -> DataFrame:
    """Click lines of the objects below a base, as they appear.

    With `folder` only that day folder (YYYY/MM/DD) is listed: a path that stays, so one checkpoint a day
    keeps it (see ledger.ingest_click_days). With `today` its day folder and those of the days before are
    listed, otherwise the whole base. `max_age` is how far behind the newest file's modification time a new file may lie and still be
    read; the default is longer than any history, so an object that arrives late is never left out.
    """
    if folder is not None:
        path = f"{base.rstrip('/')}/{folder}*"
    else:
        path = base if today is None else f"{base.rstrip('/')}/{{{','.join(day_folders(today, days))}}}*"
    lines = (
        spark.readStream.option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .option("maxFileAge", max_age)
        .text(path)
    )
    return lines.select(*line_columns(base)).where(F.col("file_name").contains(name_part))


def ingest_clicks(
    clicks: DataFrame,
    target: str,
    checkpoint: str,
    table: str | None = None,
    buckets: int | None = None,
) -> StreamingQuery:
    """Insert a stream of raw click records into the stored table; all that is available, once.

    Exact over the whole history: each batch is compared with the stored years it touches. With a
    bucketed `table` (at the target path) the stored keys are not moved for it.
    """

    def insert(batch: DataFrame, _batch_id: int) -> None:
        kept = batch.persist()
        try:
            insert_clicks(kept, target, table, buckets)
        finally:
            kept.unpersist()

    return (
        clicks.writeStream.foreachBatch(insert)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def distinct_recent_clicks(clicks: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """De-duplicated stream with bounded state: repeats are caught within the lateness only."""
    timed = clicks.withColumn("_event_time", F.col("last_modified_date").cast("timestamp"))
    late = timed.withWatermark("_event_time", lateness)
    return late.dropDuplicatesWithinWatermark(list(KEY)).drop("_event_time")


def ingest_click_folder(
    spark: SparkSession,
    base: str,
    target: str,
    checkpoint: str,
    today: date | None = None,
    table: str | None = None,
    buckets: int | None = None,
) -> StreamingQuery:
    """Ingest every click object below a base, or those of the last day folders of `today`."""
    rows = click_rows(stream_click_lines(spark, base, today=today))
    return ingest_clicks(rows, target, checkpoint, table, buckets)
