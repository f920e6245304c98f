"""Money expressions over doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_double(amount: Column) -> Column:
    return amount.cast("double")


def ieee_div(amount: Column, rate: Column) -> Column:
    """Division with IEEE results for a zero rate: x/0 is +-infinity and 0/0 is NaN."""
    zero = rate == F.lit(0.0)
    return F.when(zero, amount * F.lit(float("inf"))).otherwise(amount / F.when(~zero, rate))


def rate_or_one(row_id: Column, rate: Column) -> Column:
    """Conversion rate of the attached currency row; 1.0 when there is no row."""
    return F.when(row_id.isNull(), F.lit(1.0)).otherwise(as_double(rate))


def nonzero_or(own: Column, other: Column) -> Column:
    """Own amount unless it is null or zero, then the other amount, then 0."""
    own, other = as_double(own), as_double(other)
    return F.when(own != F.lit(0.0), own).otherwise(F.coalesce(other, F.lit(0.0)))


def percent(rate: Column) -> Column:
    """A percentage as a fraction, null counting as zero."""
    return F.coalesce(as_double(rate), F.lit(0.0)) / F.lit(100.0)


def signed_by_document(amount: Column, document_type: Column) -> Column:
    """Negated unless the document is a standard one."""
    amount = as_double(amount)
    return F.when(document_type == "standard", amount).otherwise(-amount)


def follow_sign(cost: Column, total: Column) -> Column:
    """Cost negated when the total is negative."""
    cost = as_double(cost)
    return F.when(total < F.lit(0.0), -cost).otherwise(cost)


def positive(amount: Column) -> Column:
    return F.when(amount < F.lit(0.0), -amount).otherwise(amount)


def tax_in_base(tax: Column, shipping: Column, tax_percent: Column, rate: Column) -> Column:
    """Tax plus the taxed share of shipping, converted."""
    return ieee_div(tax + shipping * tax_percent / F.lit(100.0), rate)


def untaxed_after(total: Column, tax: Column, created_at: Column, start: str) -> Column:
    """Total without tax for rows created after the start; others (and null dates) keep it."""
    later = created_at > F.lit(start).cast("timestamp_ntz")
    return F.when(later, total - F.coalesce(tax, F.lit(0.0))).otherwise(total)
