"""Table scans with declared schemas, from files or from a database."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal
from itertools import pairwise
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import table_schema


def read_table(spark: SparkSession, base: str, name: str, file_format: str = "parquet") -> DataFrame:
    """A source table stored under `<base>/<name>`."""
    return spark.read.schema(table_schema(name)).format(file_format).load(f"{base}/{name}")


def jdbc_options(
    url: str, table: str, column: str, lower: Any, upper: Any, partitions: int, fetch_rows: int = 5000
) -> dict[str, str]:
    """Options of a parallel database scan, split on a numeric or date column."""
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
        "fetchsize": str(fetch_rows),
        "pushDownPredicate": "true",
    }


def equal_depth_bounds(keys: DataFrame, column: str, partitions: int) -> list[Any]:
    """Up to `partitions` - 1 values of a number or time column, rising, between which equally many rows lie.

    `keys` is a sample of the table's key column, or the column itself; only these values are collected.
    A value that many rows share is one bound: its rows lie in one range, as with any split on the key.
    """
    shares = [i / partitions for i in range(1, partitions)]
    present = keys.where(F.col(column).isNotNull())
    bounds = present.agg(F.percentile_approx(column, shares, 100 * partitions).alias("bounds")).first()["bounds"]
    return sorted(set(bounds or []))


def range_predicates(column: str, bounds: Sequence[Any]) -> list[str]:
    """SQL conditions of the ranges between rising bounds, and of the nulls: each row meets exactly one."""
    values = [str(b) if isinstance(b, (int, float, Decimal)) else f"'{b}'" for b in bounds]
    if not values:
        return [f"{column} IS NOT NULL", f"{column} IS NULL"]
    between = [f"{column} >= {a} AND {column} < {b}" for a, b in pairwise(values)]
    return [f"{column} < {values[0]}", *between, f"{column} >= {values[-1]}", f"{column} IS NULL"]


def read_database_ranges(
    spark: SparkSession,
    url: str,
    table: str,
    predicates: Sequence[str],
    properties: Mapping[str, str] | None = None,
    name: str | None = None,
) -> DataFrame:
    """A database table with one task per predicate, for keys that are spread unevenly over their range.

    Nulls have a task of their own. With the `name` of a source table, its columns get the declared names.
    """
    options = {"fetchsize": "5000", "pushDownPredicate": "true", **(properties or {})}
    frame = spark.read.jdbc(url, table, predicates=list(predicates), properties=options)
    return frame if name is None else declared(frame, name)


# Names in the database that differ from the declared ones.
SOURCE_NAMES = {"type": "type_", "orgaization_id": "organization_id"}


def declared(frame: DataFrame, name: str) -> DataFrame:
    """A frame with the database's own column names as the declared schema of table `name`.

    Columns that are not declared are left out; a declared column that is missing is an error.
    """
    wanted = table_schema(name)
    have = {c.lower(): c for c in frame.columns}
    source = {new: old for old, new in SOURCE_NAMES.items()}
    columns = []
    for field in wanted:
        found = have.get(field.name) or have.get(source.get(field.name, ""))
        if found is None:
            raise ValueError(f"table {name} has no column {field.name}")
        columns.append(F.col(f"`{found}`").cast(field.dataType).alias(field.name))
    return frame.select(*columns)


def read_database_table(spark: SparkSession, options: Mapping[str, str], name: str | None = None) -> DataFrame:
    """A database table as a partitioned scan; filters and projections are evaluated at the source.

    With the `name` of a source table, its columns get the declared names and types.
    """
    frame = spark.read.format("jdbc").options(**options).load()
    return frame if name is None else declared(frame, name)
