"""Boost scores from a warehouse table or an exported CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import BOOST_SCORES


def read_scores_table(spark: SparkSession, table: str = "updated_booster") -> DataFrame:
    """All scores of a catalog table."""
    return spark.table(table)


def read_scores_csv(spark: SparkSession, path: str) -> DataFrame:
    """Scores from CSV with a header; a malformed line stops the job."""
    return (
        spark.read.schema(BOOST_SCORES).option("header", "true").option("mode", "FAILFAST").csv(path)
    )
