"""Ordered paging. Both forms need a key, so that a page has a defined content."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from ..session import work_folder

PAGE_ROWS = 100


def page_after(frame: DataFrame, key: str, last: Any | None, rows: int = PAGE_ROWS) -> DataFrame:
    """The next page after a key (keyset form): the filter is pushed down and the sort keeps only
    `rows` rows per task."""
    rest = frame if last is None else frame.where(F.col(key) > F.lit(last))
    return rest.orderBy(key).limit(rows)


def page_at(frame: DataFrame, key: str, number: int, rows: int = PAGE_ROWS) -> DataFrame:
    """Page by 0-based number. Cost grows with the number; prefer page_after."""
    return frame.orderBy(key).offset(number * rows).limit(rows)


def page_index(frame: DataFrame, key: str, folder: str, rows: int = PAGE_ROWS) -> DataFrame:
    """The bounds of all pages in key order: (page from 0, first, last, rows). The key is unique and not null.

    One range-partitioned sort of the keys alone, written to `folder` with each key's place in its
    partition. The rows of a partition are counted there, and sums of these counts turn places into page
    numbers, so no task sees more than its partition and the driver sees nothing.
    """
    spark = frame.sparkSession
    place = F.monotonically_increasing_id()
    ordered = frame.select(F.col(key).alias("key")).repartitionByRange("key").sortWithinPartitions("key")
    ordered.select("key", F.shiftright(place, 33).alias("part"), place.bitwiseAND(F.lit((1 << 33) - 1)).alias("place")).write.parquet(folder)
    return _numbered(spark, folder, rows).groupBy("page").agg(
        F.min("key").alias("first"), F.max("key").alias("last"), F.count(F.lit(1)).alias("rows")
    )


def _numbered(spark: SparkSession, folder: str, rows: int) -> DataFrame:
    """(key, page) of the keys that `page_index` has written."""
    keys = spark.read.parquet(folder)
    counts = keys.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    # A row per partition of the sort: few enough for one window.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    return keys.join(starts, "part").select("key", F.expr(f"(start + place) div {rows}").alias("page"))


def page_of(frame: DataFrame, key: str, bounds: Row) -> DataFrame:
    """The rows of a page of the index, as a range of the key that reaches the scan."""
    return frame.where(F.col(key).between(F.lit(bounds["first"]), F.lit(bounds["last"]))).orderBy(key)


def paged(frame: DataFrame, key: str, folder: str, rows: int = PAGE_ROWS) -> DataFrame:
    """All rows with the number `page` of their page and the page's number of rows, `page_rows`."""
    sizes = page_index(frame, key, folder, rows).select("page", F.col("rows").alias("page_rows"))
    numbers = _numbered(frame.sparkSession, folder, rows).withColumnRenamed("key", key)
    return frame.join(numbers, key).join(sizes, "page")


def pages(
    frame: DataFrame, key: str, rows: int = PAGE_ROWS, folder: str | None = None
) -> Iterator[DataFrame]:
    """Pages in key order. The key must be unique and not null.

    The keys are sorted once (see page_index; `folder` is a new one in the shared folder by default). A page
    is a range of the key over the frame, so of the table only bounds of pages come to the driver, one
    partition of the index at a time.
    """
    folder = folder or work_folder(frame.sparkSession)
    bounds = page_index(frame, key, f"{folder}/keys", rows)
    for row in bounds.orderBy("page").toLocalIterator():
        yield page_of(frame, key, row)
