"""Every entity output by name, with the source tables it needs."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import date
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import read_table
from .clicks import flat_clicks
from .events import (
    events_by_module,
    events_with_email,
    forms_by_module,
    refresh_spans,
    week_spans,
)
from .invoices import invoice_report
from .orders import order_report
from .proposals import proposal_report
from .purchase_orders import purchase_order_report, retail_totals
from .ratings import rating_report
from .snapshots import SNAPSHOTS, snapshot


@dataclass(frozen=True)
class Output:
    """A full-refresh output: a function of its source tables, in that order."""

    tables: tuple[str, ...]
    plan: Callable[..., DataFrame]


OUTPUTS: dict[str, Output] = {
    "purchase_orders": Output(
        ("purchase_orders", "currencies", "shippings", "taxes", "providers", "action_items"),
        purchase_order_report,
    ),
    "purchase_order_totals": Output(
        ("purchase_orders", "milestones", "shippings", "currencies"), retail_totals
    ),
    "proposals": Output(
        ("proposals", "currencies", "turn_around_times", "taxes", "providers"), proposal_report
    ),
    "orders": Output(("orders", "providers", "requests", "users", "timepoints"), order_report),
    "invoices": Output(("invoices", "currencies", "shippings"), invoice_report),
    "ratings": Output(("ratings", "providers"), rating_report),
    "clicks": Output(("clicks",), flat_clicks),
    **{name: Output((spec.table,), partial(snapshot, name)) for name, spec in SNAPSHOTS.items()},
}


@dataclass(frozen=True)
class Windowed:
    """An output refreshed by windows: rows of the windows, partition columns and partition values."""

    table: str
    partition_by: tuple[str, ...]
    plan: Callable[[SparkSession, DataFrame, date], tuple[DataFrame, list[Mapping[str, object]]]]


def _modules(plan):
    def rows(spark: SparkSession, table: DataFrame, today: date):
        spans = refresh_spans(spark, today)
        return plan(table, [span for _, span in spans]), [{"dt": label} for label, _ in spans]

    return rows


def _weeks(spark: SparkSession, table: DataFrame, today: date):
    weeks = week_spans(spark, today)
    values = [{"dt_year": m.year, "dt_month": m.month, "dt_start_week": m.day} for m, _ in weeks]
    return events_with_email(table, [span for _, span in weeks]), values


WINDOWED: dict[str, Windowed] = {
    "events": Windowed("events", ("dt",), _modules(events_by_module)),
    "embedded_dynamic_forms": Windowed("embedded_dynamic_forms", ("dt",), _modules(forms_by_module)),
    "events_emails": Windowed("events", ("dt_year", "dt_month", "dt_start_week"), _weeks),
}


def build(spark: SparkSession, name: str, base: str) -> DataFrame:
    """A full-refresh output over the source tables stored under a base."""
    output = OUTPUTS[name]
    return output.plan(*[read_table(spark, base, table) for table in output.tables])
