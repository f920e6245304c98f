"""Catalog registration of Parquet data sets."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType


def register(
    spark: SparkSession,
    table: str,
    path: str,
    schema: StructType,
    partition_by: Sequence[str] = (),
    partitions: Iterable[Mapping[str, object]] | None = None,
) -> None:
    """Register or refresh an external table over a data set; no data are touched.

    A table without partitions that is registered already is pointed at the new place in one step, so
    readers find the old or the new data set and never no table. With `partitions` (the ones a run has
    written) these are added and no other one is listed; without, all are recovered from the folders.
    Only other columns, or another place of a partitioned table, make the table anew.
    """
    known = spark.catalog.tableExists(table)
    if known and not _fits(spark, table, path, schema, partition_by):
        spark.sql(f"DROP TABLE {table}")
        known = False
    if not known:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        parts = f"PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet {parts} LOCATION '{path}'")
    elif _plain(_location(spark, table)) != _plain(path):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    if partition_by and (partitions is None or not known):
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    elif partition_by:
        specs = [", ".join(f"`{c}` = '{_quoted(w[c])}'" for c in partition_by) for w in partitions]
        if specs:
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS " + " ".join(f"PARTITION ({s})" for s in specs))
    spark.catalog.refreshTable(table)


def _fits(spark: SparkSession, table: str, path: str, schema: StructType, partition_by: Sequence[str]) -> bool:
    """Whether a registered table can stay: the same columns, and no partitions that lie elsewhere."""
    have = {(f.name, f.dataType) for f in spark.table(table).schema.fields}
    parts = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    if have != {(f.name, f.dataType) for f in schema.fields} or parts != list(partition_by):
        return False
    return not partition_by or _plain(_location(spark, table)) == _plain(path)


def _quoted(value: object) -> str:
    return str(value).replace("\\", "\\\\").replace("'", "\\'")


def _location(spark: SparkSession, table: str) -> str:
    """Where the data of a registered table lie."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
    return described.where("col_name = 'Location'").first()["data_type"]


def _plain(path: str) -> str:
    """A path without the local scheme and trailing slashes."""
    return re.sub(r"^file:/*", "/", path).rstrip("/")
