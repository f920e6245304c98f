"""Schema-driven projection: the output schema decides the select list."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def select_list(columns: Sequence[str], expressions: Mapping[str, Column]) -> list[Column]:
    """One column per output name: its expression, or the source column of the same name."""
    return [expressions.get(c, F.col(c)).alias(c) for c in columns]


def project(
    frame: DataFrame, columns: Sequence[str], expressions: Mapping[str, Column] | None = None
) -> DataFrame:
    return frame.select(*select_list(columns, expressions or {}))
