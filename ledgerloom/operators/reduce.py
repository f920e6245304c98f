"""One row per key out of many child rows, by row order.

The choice is deterministic: the child with the largest (last) or smallest (first) order value wins.
All forms are plain aggregates, so a hot key is combined on the map side before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Satellite:
    """A child frame to be gathered by parent key.

    Output columns are `<name>_<column>`, and `<name>_id`, which is null when the parent has no
    child. Test presence on `<name>_id`: the other columns may be null in a present row.
    """

    name: str
    frame: DataFrame
    key: str
    columns: Sequence[str]
    pick: str = "last"
    order: str = "id"

    def rows(self, key: str) -> DataFrame:
        values = [F.col(c).alias(f"{self.name}_{c}") for c in self.columns]
        return self.frame.where(F.col(self.key).isNotNull()).select(
            F.col(self.key).alias(key), F.col(self.order).alias(f"{self.name}_id"), *values
        )

    def picks(self) -> list[Column]:
        order = f"{self.name}_id"
        by, edge = (F.max_by, F.max) if self.pick == "last" else (F.min_by, F.min)
        chosen = [by(f"{self.name}_{c}", order).alias(f"{self.name}_{c}") for c in self.columns]
        return [edge(order).alias(order), *chosen]


def gather(key: str, *satellites: Satellite) -> DataFrame:
    """All satellites of a key in one row, with one shuffle for all of them.

    The children are stacked and aggregated together; max_by / min_by ignore the rows of the other
    children because their order column is null there.
    """
    stacked = reduce(
        lambda left, right: left.unionByName(right, allowMissingColumns=True),
        [s.rows(key) for s in satellites],
    )
    picks = [pick for s in satellites for pick in s.picks()]
    return stacked.groupBy(key).agg(*picks)


def pick_rows(frame: DataFrame, key: Sequence[str], order: str, pick: str = "last") -> DataFrame:
    """Whole first or last row per key; rows with a null key are dropped."""
    by = F.max_by if pick == "last" else F.min_by
    rest = [c for c in frame.columns if c not in key]
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])
    chosen = frame.where(present).groupBy(*key).agg(by(F.struct(*rest), F.col(order)).alias("_row"))
    return chosen.select(*key, "_row.*").select(*frame.columns)


def latest_per_name(
    frame: DataFrame, key: str, name: str, value: str, columns: dict[str, str], order: str = "id"
) -> DataFrame:
    """Conditional pivot: per key, the last value of each named row, one column per name."""
    picks = []
    for column, label in columns.items():
        hit = F.col(name) == label
        picks.append(F.max_by(F.when(hit, F.col(value)), F.when(hit, F.col(order))).alias(column))
    named = frame.where(F.col(key).isNotNull() & F.col(name).isin(*columns.values()))
    return named.groupBy(key).agg(*picks)
