"""Ratings that are not spam, with the provider's name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import flag_text
from ..operators.lookup import DEFAULT_POLICY, SkewPolicy, lookup
from ..operators.project import project

REPORT_COLUMNS = (
    "id", "value", "ware_id", "spam", "provider_id", "provider_name", "created_at", "created_on",
    "request_id", "order_id", "comment", "organization_id", "user_id",
)


def rating_report(
    ratings: DataFrame, providers: DataFrame, policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    kept = ratings.where(~F.col("spam"))
    names = providers.select(F.col("id").alias("_provider"), F.col("name").alias("provider_name"))
    rows = lookup(kept, names, {"provider_id": "_provider"}, policy=policy)
    return project(
        rows,
        REPORT_COLUMNS,
        {"spam": flag_text(F.col("spam")), "created_on": F.to_date("created_at")},
    )
