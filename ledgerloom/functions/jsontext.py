"""JSON expressions over text columns, parsed once per value into a variant."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def parsed(text: Column) -> Column:
    return F.parse_json(text)


def canonical(text: Column) -> Column:
    """Compact JSON text with sorted keys; null stays null."""
    return F.to_json(parsed(text))


def _member(value: Column, key: str) -> Column:
    return F.variant_get(value, f"$['{key}']", "variant")


def member_text(value: Column, key: str, source: Column | None = None) -> Column:
    """A member as JSON text, quotes kept; missing gives null, JSON null gives 'null'.

    A variant stores 1.0 and 1e2 as whole numbers. With the `source` text a number is printed as the
    floating-point value it is: 1.0, 100.0, 1.5 (also for 1.50), 1e22; whole numbers stay whole.
    """
    text = F.to_json(_member(value, key))
    if source is None:
        return text
    number = F.from_json(source, StructType([StructField(key, StringType())]))[key]
    return F.when(text.rlike("^-?[0-9]"), F.regexp_replace(number, r"(\.0)?E", "e")).otherwise(text)


def member_quoted(value: Column, key: str, source: Column | None = None) -> Column:
    """A member as JSON text, quotes kept; missing gives the text 'null'."""
    return F.coalesce(member_text(value, key, source), F.lit("null"))


def member_bare(value: Column, key: str, source: Column | None = None) -> Column:
    """A member as JSON text without any double quote; missing gives ''."""
    return F.coalesce(F.replace(member_text(value, key, source), F.lit('"')), F.lit(""))


def first_number(value: Column, key: str) -> Column:
    """First element of an array member, or the scalar member itself, as double; else null."""
    return F.coalesce(
        F.try_variant_get(value, f"$['{key}'][0]", "double"),
        F.try_variant_get(value, f"$['{key}']", "double"),
    )
