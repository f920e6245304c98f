"""Score write-back: new booster values by ware, organization and provider."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.lookup import DEFAULT_POLICY, SkewPolicy, lookup

KEY = ("ware_id", "organization_id", "provider_id")
SCORE_TYPE = "decimal(3,2)"


def _required(column: str, kind: str = "int") -> Column:
    """A typed column that must not be null. The check sits in the value, where no filter that the
    optimizer derives from a later join can get ahead of it."""
    missing = F.raise_error(F.lit(f"score without {column}")).cast(kind)
    return F.coalesce(F.col(column).cast(kind), missing)


def accepted_scores(scores: DataFrame) -> DataFrame:
    """Scores flagged for update, typed. A null key part or score, or a score that does not
    fit DECIMAL(3,2), stops the job."""
    return scores.where(F.col("update") == "true").select(
        F.col("id").cast("int").alias("id"),
        *(_required(c).alias(c) for c in KEY),
        _required("updated_booster", SCORE_TYPE).alias("booster"),
    )


def one_score_per_key(scores: DataFrame) -> DataFrame:
    """The scores by key; a key held twice stops the job."""
    message = F.concat(F.lit("score key repeated: "), F.concat_ws(",", *KEY))
    repeated = F.raise_error(message).cast(SCORE_TYPE)
    once = F.when(F.count(F.lit(1)) == 1, F.min("booster")).otherwise(repeated)
    return scores.groupBy(*KEY).agg(once.alias("_boost"))


def boosted(
    wpcs: DataFrame, scores: DataFrame, policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """All configurations, with the new booster where a score exists for the key."""
    fresh = one_score_per_key(accepted_scores(scores))
    rows = lookup(wpcs, fresh, {k: k for k in KEY}, policy=policy)
    new = F.coalesce(F.col("_boost").cast("double"), F.col("booster"))
    return rows.withColumn("booster", new).select(*wpcs.columns)


def changed_rows(
    wpcs: DataFrame, scores: DataFrame, policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """The configurations whose booster a score changes; of them the key and the booster are read."""
    fresh = one_score_per_key(accepted_scores(scores))
    rows = lookup(wpcs, fresh, {k: k for k in KEY}, policy=policy)
    return rows.where(~F.col("_boost").cast("double").eqNullSafe(F.col("booster")) & F.col("_boost").isNotNull()).drop("_boost")
