"""Text, array and placeholder expressions."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def joined(items: Column) -> Column:
    """Array elements joined by ', '; a null array stays null."""
    return F.array_join(items, ", ")


def joined_or_empty(items: Column) -> Column:
    """Array elements joined by ', '; a null array gives ''."""
    return F.coalesce(joined(items), F.lit(""))


def flag_text(flag: Column) -> Column:
    """Boolean as the text 'true' / 'false'."""
    return flag.cast("string")


def item_or_empty(items: Column, position: int) -> Column:
    """Element at a 0-based position; '' for a null array, a short array or a null element."""
    return F.coalesce(F.get(items, F.lit(position)), F.lit(""))


def full_name(first: Column, last: Column) -> Column:
    """The present name parts joined by a space; null only when both are null."""
    return F.when(F.coalesce(first, last).isNotNull(), F.concat_ws(" ", first, last))


def address_line(*parts: Column) -> Column:
    """Non-null address parts joined by a space; an empty line becomes null."""
    return F.nullif(F.concat_ws(" ", *parts), F.lit(""))


def checklist_score(items: Column, weights: Mapping[str, int]) -> Column:
    """Sum of the weights of the recognised items, repeats counted.

    Items are taken from the comma-split joined text, so an element holding a comma counts as two.
    Each distinct weight costs one regexp_count over the joined text, which stays in generated code.
    """
    by_weight: dict[int, list[str]] = defaultdict(list)
    for name, weight in weights.items():
        by_weight[weight].append(re.escape(name))
    text = joined(items)
    score = F.lit(0)
    for weight, names in by_weight.items():
        pattern = r"(?:^|,)[\s\p{Z}]*(?:" + "|".join(names) + r")(?=,|\z)"
        score = score + F.coalesce(F.regexp_count(text, F.lit(pattern)), F.lit(0)) * F.lit(weight)
    return score.cast("int")


def or_timestamp(value: Column, placeholder: str) -> Column:
    """A null timestamp replaced by a fixed one."""
    return F.coalesce(value, F.lit(placeholder).cast("timestamp_ntz"))


def or_date(value: Column, placeholder: str) -> Column:
    """Date of a timestamp, a null replaced by a fixed date."""
    return F.coalesce(F.to_date(value), F.lit(placeholder).cast("date"))
