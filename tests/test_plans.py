"""Physical plans: what is read, pushed, shuffled and never done."""

import pytest

from checks.entities import Entities
from checks.queries import QUERIES
from ledgerloom.operators.lookup import SkewPolicy
from ledgerloom.operators.reduce import Satellite, gather
from ledgerloom.plans import clicks, events, purchase_orders
from ledgerloom.plans.snapshots import snapshot
from ledgerloom.schemas import table_schema
from ledgerloom.sinks.upsert import create_click_table

FOLDER = "/root/testdata/sf0.001"
# Queries that write or stream while they are built.
WRITERS = {
    "clicks_from_objects", "clicks_inserted_twice", "clicks_inserted_bucketed", "stream_clicks_available_now", "run_manifest",
    "partition_refresh", "week_partition_refresh", "snapshot_registered",
}


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def optimized(frame) -> str:
    return frame._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(autouse=True)
def long_plans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    spark.conf.set("spark.sql.debug.maxToStringFields", "500")


@pytest.fixture
def stored(spark, tmp_path):
    """An empty Parquet data set of a declared table."""

    def build(name):
        path = f"{tmp_path}/{name}"
        spark.createDataFrame([], table_schema(name)).coalesce(1).write.parquet(path)
        return spark.read.schema(table_schema(name)).parquet(path)

    return build


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITERS))
def test_no_python_no_cross_join(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    for forbidden in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEval"):
        assert forbidden not in plan


def scan_columns(plan: str, hint: str) -> set[str]:
    """Columns of the first scan whose path holds the hint."""
    for line in plan.splitlines():
        if "FileScan parquet" in line and hint in line:
            schema = line.split("ReadSchema: struct<")[1].rsplit(">", 1)[0]
            return {part.split(":")[0] for part in schema.split(",") if ":" in part}
    raise AssertionError(f"no scan of {hint}")


def test_snapshot_reads_only_its_columns(stored):
    plan = plan_of(snapshot("addresses", stored("addresses")))
    assert len(scan_columns(plan, "addresses")) == 16


def test_time_window_is_pushed_to_the_scan(spark, stored):
    from datetime import date

    spans = [s for _, s in events.refresh_spans(spark, date(2024, 6, 15))]
    plan = plan_of(events.events_by_module(stored("events"), spans))
    assert "GreaterThanOrEqual(created_at,2024-06-08T00:00)" in plan
    assert "LessThan(created_at,2024-06-22T00:00)" in plan and "IsNotNull(event)" in plan


def test_children_share_one_shuffle(stored):
    """Three children of one key: three scans, one shuffle."""
    found = gather(
        "key",
        Satellite("currency", stored("currencies"), "exchangable_id", ["conversion_rate"]),
        Satellite("shipping", stored("shippings"), "shipable_id", ["cost"]),
        Satellite("tax", stored("taxes"), "taxable_id", ["amount"]),
    )
    plan = plan_of(found)
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("FileScan parquet") == 3
    # Fixed-width picks need no sort before the partial aggregate.
    assert "SortAggregate" not in plan and "partial_max_by" in plan


def test_type_filters_reach_the_scans(stored):
    report = purchase_orders.purchase_order_report(
        *[
            stored(n)
            for n in (
                "purchase_orders", "currencies", "shippings", "taxes", "providers", "action_items",
            )
        ]
    )
    plan = plan_of(report)
    assert "EqualTo(action_performed,new_request)" in plan
    assert "EqualTo(type_,Pg::RetailTax)" in plan
    assert "In(shipable_type, [Pg::PurchaseOrderBase,Pg::PurchaseOrderBaseInit])" in plan
    assert scan_columns(plan, "action_items") == {"id", "action_performed", "provider_id", "order_id"}


def test_large_lookup_is_salted_and_only_hot_keys_are_broadcast(spark, stored):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = events.events_with_email(stored("events"), policy=SkewPolicy(-1, 1000))
        plan = plan_of(rows)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    assert "_salt" in plan and "SortMergeJoin" in plan and "xxhash64" in plan
    for line in plan.splitlines():
        if "BroadcastHashJoin" in line:
            assert "_hot_" in line


def test_clicks_are_parsed_once(stored):
    assert optimized(clicks.flat_clicks(stored("clicks"))).count("from_json") == 1


def test_stored_click_bodies_are_not_read_for_the_key_check(stored):
    rows = stored("clicks")
    scans = [s for s in plan_of(clicks.unseen_clicks(rows, rows)).splitlines() if "FileScan" in s]
    read = sorted("data:" in s.split("ReadSchema:")[1] for s in scans)
    assert read == [False, True]


def test_bucketed_history_is_not_shuffled(spark, stored, tmp_path):
    create_click_table(spark, "t_clicks", f"{tmp_path}/t", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        history = spark.table("t_clicks").where("year = 2024")
        plan = plan_of(clicks.unseen_clicks_by_bucket(stored("clicks"), history, 4))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
        spark.sql("DROP TABLE t_clicks")
    history = next(s for s in plan.split("FileScan") if "t_clicks" in s)
    assert "Bucketed: true" in history and "PartitionFilters: [isnotnull(year" in history
    # New rows move once for the de-duplication and once to the buckets; stored keys do not move.
    assert plan.count("Exchange hashpartitioning") == 2


def test_wide_rows_move_once_for_all_large_lookups(spark, stored):
    names = ("purchase_orders", "currencies", "shippings", "taxes", "providers", "action_items")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        report = purchase_orders.purchase_order_report(*[stored(n) for n in names])
        lines = plan_of(report).splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    wide = [i for i, line in enumerate(lines) if "FileScan" in line and "payment_terms:" in line]
    assert len(wide) == 1
    # Going up from the wide scan, the first exchange is by id; its joins by id need no other.
    above = [line for line in lines[: wide[0]] if "Exchange hashpartitioning" in line]
    assert "hashpartitioning(id#" in above[-1] and len(above) == 1
