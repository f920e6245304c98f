"""Row contracts: rules each row of a plan must satisfy."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MODES = ("fail", "valid", "rejects", "flag")


@dataclass(frozen=True)
class Rule:
    """A named condition; a null condition counts as broken."""

    name: str
    holds: Column


def not_null(*columns: str) -> list[Rule]:
    return [Rule(f"{c} is null", F.col(c).isNotNull()) for c in columns]


def violations(rules: Sequence[Rule]) -> Column:
    """Names of the broken rules of a row, as an array."""
    broken = [F.when(~F.coalesce(r.holds, F.lit(False)), F.lit(r.name)) for r in rules]
    return F.array_compact(F.array(*broken))


def enforce(
    frame: DataFrame,
    rules: Sequence[Rule],
    columns: Sequence[Column],
    mode: str = "fail",
    key: str = "id",
    label: str = "row",
) -> DataFrame:
    """Project the columns of a plan under its contract, in one pass.

    fail     stop the job at the first broken row
    valid    keep the rows that satisfy every rule
    rejects  the key and the reasons of the other rows
    flag     all rows, with the reasons in `violations`
    """
    if mode not in MODES:
        raise ValueError(f"contract mode must be one of {MODES}, not {mode!r}")
    if not rules:
        rules = [Rule("always", F.lit(True))]
    broken = violations(rules)
    if mode == "rejects":
        rejected = frame.select(F.col(key), F.array_join(broken, "; ").alias("reasons"))
        return rejected.where(F.col("reasons") != "")
    if mode == "flag":
        return frame.select(*columns, broken.alias("violations"))
    holds = F.lit(True)
    for rule in rules:
        holds = holds & F.coalesce(rule.holds, F.lit(False))
    if mode == "valid":
        return frame.where(holds).select(*columns)
    message = F.concat(
        F.lit(f"contract of {label} broken for {key}="),
        F.col(key).cast("string"),
        F.lit(": "),
        F.array_join(broken, "; "),
    )
    # A filter that raises is never pruned, unlike an unused assertion column.
    checked = frame.where(F.when(holds, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))
    return checked.select(*columns)
