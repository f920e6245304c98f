"""Equal-depth ranges of a database scan, and first e-mails that are merged instead of read again."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerloom.plans import events
from ledgerloom.sources.tables import equal_depth_bounds, range_predicates


@pytest.fixture
def keys(spark):
    """Ids with a long tail: half of them below 100, the rest up to 10^12, some repeated and some null."""
    n = F.col("id")
    wide = F.when(n % 2 == 0, n % 100).otherwise(F.pow(F.lit(10), n % 13).cast("long") + n)
    return spark.range(8000).select(F.when(n % 50 == 7, F.lit(None)).when(n % 9 == 0, F.lit(7)).otherwise(wide).cast("long").alias("k"))


@pytest.mark.parametrize("sample", [1.0, 0.25])
def test_ranges_are_disjoint_complete_and_balanced(keys, sample):
    bounds = equal_depth_bounds(keys.sample(sample, 5) if sample < 1 else keys, "k", 8)
    assert bounds == sorted(set(bounds)) and 4 <= len(bounds) <= 7
    predicates = range_predicates("k", bounds)
    met = sum(F.coalesce(F.expr(p).cast("int"), F.lit(0)) for p in predicates)
    assert keys.where(met != 1).count() == 0
    sizes = [keys.where(p).count() for p in predicates]
    repeated = keys.groupBy("k").count().agg(F.max("count")).first()[0]
    assert sum(sizes) == 8000 and max(sizes) <= 8000 / 8 * 1.3 + repeated
    # A linear split of the same range puts nearly everything into one task.
    low, high = keys.agg(F.min("k"), F.max("k")).first()
    assert keys.where(F.col("k") < low + (high - low) / 8).count() > 7000


def test_ranges_of_few_values(spark, keys):
    assert equal_depth_bounds(keys.limit(0), "k", 4) == []
    assert range_predicates("k", []) == ["k IS NOT NULL", "k IS NULL"]
    assert equal_depth_bounds(keys.where("k = 7"), "k", 4) == [7]
    days = spark.sql("select timestamp'2024-01-01' + make_interval(0,0,0,cast(id as int)) as k from range(100)")
    predicates = range_predicates("k", equal_depth_bounds(days, "k", 4))
    assert [days.where(p).count() for p in predicates][-1] == 0 and sum(days.where(p).count() for p in predicates) == 100


def event(i, day, session, email, name="view"):
    return dict(id=i, event=name, uuid=f"u{i}", session_id=session, email=email, created_at=datetime(2024, 1, 1) + timedelta(days=day))


def test_merged_first_emails_equal_a_full_run(spark, table):
    rows = [event(i, i % 20, f"s{i % 5}" if i % 11 else None, f"e{i % 7}" if i % 3 else None, "view" if i % 13 else None) for i in range(200)]
    source = table("events", *rows)
    full = {tuple(r) for r in events.first_emails(source.where("event is not null").withColumn("_week", events.week_start(F.col("created_at")))).collect()}
    parts = [events.email_state(source.where(F.col("id") % 3 == k)) for k in range(3)]
    overlap = events.email_state(source.where("id < 60"))
    for order in ((0, 1, 2), (2, 0, 1)):
        merged = events.merged_email_states(*[parts[k] for k in order], overlap)
        assert {tuple(r) for r in events.known_emails(merged).collect()} == full
    empty = events.email_state(source.limit(0))
    assert {tuple(r) for r in events.known_emails(events.merged_email_states(empty, *parts)).collect()} == full


def test_later_days_do_not_read_the_earlier_ones(spark, table):
    early = table("events", event(1, 0, "s", "first"), event(2, 0, "t", None))
    late = table("events", event(3, 2, "s", "second"), event(4, 2, "t", "third"), event(5, 8, "s", "other week"))
    found = events.events_with_email(late, state=events.email_state(early))
    assert {r.id: r.full_email for r in found.collect()} == {3: "first", 4: "third", 5: "other week"}
