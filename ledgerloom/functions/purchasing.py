"""Purchase-order flags, the status ladder and turn-around units."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_amended(version_number: Column, referenced_po_id: Column) -> Column:
    return (version_number > 1) & referenced_po_id.isNotNull()


def is_requisition(po_number: Column) -> Column:
    return po_number.isNull()


def po_status(
    obsoleted: Column,
    version_number: Column,
    referenced_po_id: Column,
    completed: Column,
    rejected: Column,
    po_number: Column,
) -> Column:
    """First matching state of the ladder; null flags never match."""
    return (
        F.when(obsoleted, "Obsoleted")
        .when(is_amended(version_number, referenced_po_id), "Amended")
        .when(completed, "Completed")
        .when(rejected, "Rejected")
        .when(is_requisition(po_number), "Awaiting PO")
        .otherwise("Work in Progress")
    )


def turn_around_units(seconds: Column, display_units: Column) -> Column:
    """Whole hours, weeks, months (30 days) or days, truncated."""
    unit = (
        F.when(display_units == "hours", F.lit(3600))
        .when(display_units == "weeks", F.lit(604800))
        .when(display_units == "months", F.lit(2592000))
        .otherwise(F.lit(86400))
    )
    return F.call_function("div", seconds, unit)
