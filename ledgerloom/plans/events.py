"""Events by month-week module and by ISO week, and forms by month-week module."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import (
    contiguous_windows,
    month_week_label,
    month_week_windows,
    trailing_weeks,
    week_start,
)
from ..functions.jsontext import canonical
from ..functions.text import joined_or_empty
from ..operators.lookup import DEFAULT_POLICY, SkewPolicy, lookup
from ..operators.project import project

EVENT_COLUMNS = (
    "id", "event", "email", "username", "application", "duration", "remote_addr", "host", "action",
    "controller", "session_id", "computer_id", "query", "raw_post", "categories", "source",
    "providers", "uuid", "datetime", "created_at", "updated_at",
)
EMAIL_COLUMNS = (*EVENT_COLUMNS, "organization_id", "full_email")
FORM_COLUMNS = (
    "id", "name", "version_number", "slug", "key", "schema", "options", "data", "created_at",
    "updated_at",
)

Span = tuple[date, date]


def refresh_spans(spark: SparkSession, today: date, mode: str = "reference") -> list[tuple[str, Span]]:
    """Partition label and first / last day of each module to rebuild: at most eight rows.

    `reference` is the historical set (see month_week_windows); `contiguous` is the current module
    and the one before it in time.
    """
    windows = {"reference": month_week_windows, "contiguous": contiguous_windows}[mode]
    found = spark.range(1).select(windows(F.lit(today)).alias("w")).first()["w"]
    return [(f"{w.year}-{w.month}-{w.week}", (w.first_day, w.last_day)) for w in found]


def week_spans(spark: SparkSession, today: date, days_back: int = 37) -> list[tuple[date, Span]]:
    """Monday and first / last day of each trailing ISO week."""
    mondays = spark.range(1).select(trailing_weeks(F.lit(today), days_back).alias("w")).first()["w"]
    return [(monday, (monday, monday + timedelta(days=6))) for monday in mondays]


def within(stamp: Column, spans: Sequence[Span]) -> Column:
    """Timestamp inside any of the closed day ranges, as plain comparisons that a scan can use.

    Ranges that touch are merged first, so the usual case is a single pair of bounds.
    """
    merged: list[list[date]] = []
    for first, last in sorted(spans):
        if merged and first <= merged[-1][1] + timedelta(days=1):
            merged[-1][1] = max(merged[-1][1], last)
        else:
            merged.append([first, last])
    parts = []
    for first, last in merged:
        low = F.lit(first.isoformat()).cast("timestamp_ntz")
        high = F.lit((last + timedelta(days=1)).isoformat()).cast("timestamp_ntz")
        parts.append((stamp >= low) & (stamp < high))
    return reduce(lambda a, b: a | b, parts)


def _event_expressions(categories_from: str) -> dict[str, Column]:
    return {
        "categories": joined_or_empty(F.col(categories_from)),
        "source": joined_or_empty(F.col("source")),
        "providers": canonical(F.col("providers")),
    }


def events_by_module(
    events: DataFrame, spans: Sequence[Span] | None = None, categories_from: str = "source"
) -> DataFrame:
    """Named events with their partition label `dt`; all of them, or those inside the spans.

    `categories` is filled from `source`, as consumers expect; pass categories_from="categories"
    for the column of that name.
    """
    kept = events.where(F.col("event").isNotNull())
    if spans is not None:
        kept = kept.where(within(F.col("created_at"), spans))
    expressions = {
        **_event_expressions(categories_from),
        "dt": month_week_label(F.col("created_at")),
    }
    return project(kept, (*EVENT_COLUMNS, "dt"), expressions)


def events_with_email(
    events: DataFrame,
    spans: Sequence[Span] | None = None,
    categories_from: str = "source",
    policy: SkewPolicy = DEFAULT_POLICY,
    state: DataFrame | None = None,
) -> DataFrame:
    """Named events with the first e-mail of their session in the same ISO week.

    With a `state` (see email_state) of earlier events, only later ones need be given: the first e-mail of a
    session is that of the state and the events together.

    The first e-mail per (week, session) is a small aggregate; it is looked up again from the events,
    so a session holding a large share of the rows is spread instead of filling one window task. A
    null session never matches.
    """
    kept = events.where(F.col("event").isNotNull())
    if spans is not None:
        kept = kept.where(within(F.col("created_at"), spans))
    kept = kept.withColumn("_week", week_start(F.col("created_at")))
    if state is None:
        emails = first_emails(kept)
    else:
        emails = known_emails(merged_email_states(state, _email_state(kept)))
    rows = lookup(
        kept, emails, {"_week": "_email_week", "session_id": "_email_session"}, policy=policy
    )
    week = F.col("_week")
    expressions = {
        **_event_expressions(categories_from),
        "application": F.lit(""),
        "full_email": F.col("first_email"),
        "dt_year": F.year(week),
        "dt_month": F.month(week),
        "dt_start_week": F.dayofmonth(week),
    }
    return project(rows, (*EMAIL_COLUMNS, "dt_year", "dt_month", "dt_start_week"), expressions)


def first_emails(events: DataFrame) -> DataFrame:
    """First e-mail, by event id, of each session and week (`_week` is the Monday)."""
    known = events.where(F.col("session_id").isNotNull() & F.col("email").isNotNull())
    return known.groupBy(
        F.col("_week").alias("_email_week"), F.col("session_id").alias("_email_session")
    ).agg(F.min_by("email", "id").alias("first_email"))


def email_state(events: DataFrame) -> DataFrame:
    """(week, session_id, first_id, email) of each session and week: the first e-mail in a form that can be merged.

    A row per session and week however many events there are, so a state table partitioned by week holds all
    that a later refresh needs of the days before. It only grows: events that are withdrawn need a full run.
    """
    named = events.where(F.col("event").isNotNull())
    return _email_state(named.withColumn("_week", week_start(F.col("created_at"))))


def _email_state(events: DataFrame) -> DataFrame:
    known = events.where(F.col("session_id").isNotNull() & F.col("email").isNotNull())
    return known.groupBy(F.col("_week").alias("week"), "session_id").agg(
        F.min("id").alias("first_id"), F.min_by("email", "id").alias("email")
    )


def merged_email_states(*states: DataFrame) -> DataFrame:
    """One state of several, in any order and however their events overlap."""
    rows = states[0]
    for state in states[1:]:
        rows = rows.unionByName(state)
    return rows.groupBy("week", "session_id").agg(
        F.min("first_id").alias("first_id"), F.min_by("email", "first_id").alias("email")
    )


def known_emails(state: DataFrame) -> DataFrame:
    """A state in the form of `first_emails`."""
    return state.select(
        F.col("week").alias("_email_week"), F.col("session_id").alias("_email_session"), F.col("email").alias("first_email")
    )


def forms_by_module(forms: DataFrame, spans: Sequence[Span] | None = None) -> DataFrame:
    """Forms with their partition label `dt`; all of them, or those inside the spans."""
    kept = forms if spans is None else forms.where(within(F.col("created_at"), spans))
    expressions = {c: canonical(F.col(c)) for c in ("schema", "options", "data")}
    expressions["dt"] = month_week_label(F.col("created_at"))
    return project(kept, (*FORM_COLUMNS, "dt"), expressions)
