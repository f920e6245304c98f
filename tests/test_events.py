from datetime import date, datetime

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerloom.operators.lookup import SkewPolicy
from ledgerloom.plans import events
from ledgerloom.sinks.parquet import manifest_totals, refresh_partitions

TODAY = date(2024, 6, 15)


def event(id, at, **more):
    created = datetime.fromisoformat(at)
    return dict(id=id, event="view", uuid="u", created_at=created) | more


def test_spans(spark):
    spans = events.refresh_spans(spark, TODAY)
    assert spans == [
        ("2024-6-2", (date(2024, 6, 8), date(2024, 6, 14))),
        ("2024-6-3", (date(2024, 6, 15), date(2024, 6, 21))),
    ]
    weeks = events.week_spans(spark, TODAY)
    assert weeks[0][0] == date(2024, 5, 6) and weeks[-1][0] == date(2024, 6, 10)
    assert len(events.refresh_spans(spark, date(2024, 1, 3))) == 8


def test_window_bounds(table):
    rows = table(
        "events",
        event(1, "2024-06-07T23:59:59.999999"), event(2, "2024-06-08T00:00:00"),
        event(3, "2024-06-21T23:59:59.999999"), event(4, "2024-06-22T00:00:00"),
        event(5, "2024-06-10T00:00:00", event=None),
    )
    spans = [(date(2024, 6, 8), date(2024, 6, 14)), (date(2024, 6, 15), date(2024, 6, 21))]
    got = {r.id: r for r in events.events_by_module(rows, spans).collect()}
    assert set(got) == {2, 3} and got[2].dt == "2024-6-2" and got[3].dt == "2024-6-3"


def test_categories_come_from_source(table):
    rows = table("events", event(1, "2024-06-08", source=["a", "b"], categories=["c"], providers='{"k": 1}'))
    row = events.events_by_module(rows).first()
    assert (row.categories, row.source, row.providers) == ("a, b", "a, b", '{"k":1}')
    assert events.events_by_module(rows, categories_from="categories").first().categories == "c"
    assert events.events_by_module(table("events", event(1, "2024-06-08"))).first().source == ""


@pytest.mark.parametrize("policy", [SkewPolicy(), SkewPolicy(-1, 2)])
def test_session_email(table, policy):
    rows = table(
        "events",
        event(1, "2024-06-10", session_id="s"),
        event(2, "2024-06-11", session_id="s", email="e1"),
        event(3, "2024-06-12", session_id="s", email="e2"),
        event(4, "2024-06-12", session_id=None, email="e3"),
        event(5, "2024-06-17", session_id="s"),
        event(6, "2024-06-11", session_id="s", email="e0", event=None),
    )
    got = {r.id: r for r in events.events_with_email(rows, policy=policy).collect()}
    assert {i: r.full_email for i, r in got.items()} == {1: "e1", 2: "e1", 3: "e1", 4: None, 5: None}
    assert got[1].application == "" and (got[5].dt_year, got[5].dt_month, got[5].dt_start_week) == (2024, 6, 17)


def test_session_email_equals_window_form(spark, table):
    """The lookup form agrees with the window it replaces, on a session that holds most rows."""
    rows = table(
        "events",
        *[
            event(
                i, f"2024-06-{1 + i % 28:02d}", session_id=None if i % 11 == 0 else f"s{i % 9 if i % 3 else 0}",
                email=f"e{i}" if i % 4 == 0 else None,
            )
            for i in range(200)
        ],
    )
    week = F.trunc(F.to_date("created_at"), "week")
    frame = Window.partitionBy(week, "session_id").orderBy("id").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    first = F.first("email", ignorenulls=True).over(frame)
    expected = rows.select("id", F.when(F.col("session_id").isNotNull(), first).alias("e"))
    want = {r.id: r.e for r in expected.collect()}
    for policy in (SkewPolicy(), SkewPolicy(-1, 10)):
        got = events.events_with_email(rows, policy=policy).select("id", "full_email").collect()
        assert {r.id: r.full_email for r in got} == want


def test_forms(table):
    rows = table(
        "embedded_dynamic_forms",
        dict(id=1, data='{"b":1, "a":2}', created_at=datetime(2024, 6, 29)),
        dict(id=2, created_at=datetime(2024, 7, 1)),
    )
    got = {r.id: r for r in events.forms_by_module(rows).collect()}
    assert (got[1].dt, got[1].data, got[2].dt) == ("2024-6-5", '{"a":2,"b":1}', "2024-7-1")


def files_of(spark, path):
    return {r[0] for r in spark.read.parquet(path).select("_metadata.file_path").distinct().collect()}


def test_refresh_touches_only_listed_partitions(spark, table, tmp_path):
    path = f"{tmp_path}/events"
    old = table("events", event(1, "2024-06-01"), event(2, "2024-06-09"), event(3, "2024-06-16"))
    events.events_by_module(old).write.partitionBy("dt").parquet(path)
    before = files_of(spark, path)

    spans = events.refresh_spans(spark, TODAY)
    fresh = table("events", event(4, "2024-06-09"), event(5, "2024-06-10"))
    rows = events.events_by_module(fresh, [s for _, s in spans])
    manifest = refresh_partitions(rows, path, ["dt"], [{"dt": label} for label, _ in spans])

    assert {r.window_start: r.rows for r in manifest.collect()} == {"dt=2024-6-2": 2, "dt=2024-6-3": 0}
    # The window without rows was stale: it now holds a file without rows.
    assert all(r.files >= 1 and r.bytes > 0 for r in manifest.where("rows > 0").collect())
    assert (tmp_path / "events" / "dt=2024-6-3").exists()
    assert {r.id for r in spark.read.parquet(path).collect()} == {1, 4, 5}
    kept = {f for f in before if "dt=2024-6-1" in f}
    assert kept and kept <= files_of(spark, path)
    totals = manifest_totals(manifest).first()
    assert (totals.outputs, totals.rows) == (2, 2)


def test_refresh_with_no_rows_at_all(spark, table, tmp_path):
    path = f"{tmp_path}/events"
    events.events_by_module(table("events", event(3, "2024-06-16"))).write.partitionBy("dt").parquet(path)
    spans = events.refresh_spans(spark, TODAY)
    rows = events.events_by_module(table("events"), [s for _, s in spans])
    manifest = refresh_partitions(rows, path, ["dt"], [{"dt": label} for label, _ in spans])
    assert [r.rows for r in manifest.collect()] == [0, 0]
    assert spark.read.parquet(path).count() == 0
