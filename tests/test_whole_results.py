"""Results that must not depend on table size, file age or rounding, and writers that must not lose rows."""

import gzip
import json
import os
from datetime import date
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerloom.functions.text import checklist_score
from ledgerloom.operators.lookup import Lookup, SkewPolicy, lookups
from ledgerloom.plans import clicks, purchase_orders
from ledgerloom.sinks.catalog import register
from ledgerloom.sinks.parquet import refresh_partitions
from ledgerloom.sinks.upsert import stored_clicks
from ledgerloom.sources.objects import read_click_lines
from ledgerloom.sources.tables import declared
from ledgerloom.schemas import table_schema
from ledgerloom.streaming.clicks import ingest_click_folder

TODAY = date(2024, 1, 3)


@pytest.mark.parametrize("limit", [0, 1 << 40])
def test_repeated_parents_keep_their_rows(spark, limit):
    rows = [(1, 10, "a"), (1, 11, "b"), (1, 11, "b"), (2, None, "c"), (None, 10, "d"), (3, 99, "e")]
    parent = spark.createDataFrame(rows, "id long, fk long, wide string")
    child = spark.createDataFrame([(10, "x"), (11, "y")], "cid long, value string")
    found = lookups(parent, [Lookup(child, {"fk": "cid"})], parent, policy=SkewPolicy(broadcast_bytes=limit, hot_rows=2))
    got = sorted((r.wide, r.value) for r in found.where("id is not null").collect())
    assert got == [("a", "x"), ("b", "y"), ("b", "y"), ("c", None), ("e", None)]
    assert found.count() == len(rows)


def test_stray_rows_stop_the_refresh(spark, tmp_path):
    path = f"{tmp_path}/t"
    whole = spark.createDataFrame([(i, "a" if i < 3 else "b") for i in range(8)], "id long, part string")
    refresh_partitions(whole, path, ["part"], [{"part": "a"}, {"part": "b"}])
    for stray in ("b", None):
        with pytest.raises(PySparkException, match="outside the listed partitions"):
            refresh_partitions(spark.createDataFrame([(9, "a"), (10, stray)], whole.schema), path, ["part"], [{"part": "a"}])
    assert spark.read.parquet(path).groupBy("part").count().orderBy("part").collect() == [("a", 3), ("b", 5)]


def put(base, key, record, stamp):
    path = base / key
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(gzip.compress((json.dumps(record) + "\n").encode()))
    os.utime(path, (stamp, stamp))


@pytest.mark.parametrize("today", [None, TODAY])
def test_stream_takes_new_files_of_old_date(spark, tmp_path, today):
    base, now = tmp_path / "in", 1_704_250_000
    put(base, "2024/01/03/clicks-1.gz", {"Id": "new"}, now)
    put(base, "2019/01/03/clicks-1.gz", {"Id": "other day"}, now)
    run = lambda: ingest_click_folder(spark, str(base), f"{tmp_path}/out", f"{tmp_path}/state", today).awaitTermination()
    run()
    put(base, "2024/01/03/clicks-2.gz", {"Id": "late"}, now - 20 * 86_400)
    run()
    ids = {r.id for r in stored_clicks(spark, f"{tmp_path}/out").collect()}
    assert ids == {'"new"', '"late"'} | ({'"other day"'} if today is None else set())


@pytest.mark.parametrize("folder", ["a base", "a+b%20c", "é"])
def test_object_keys_below_any_base(spark, tmp_path, folder):
    put(tmp_path / folder, "2024/01/03/clicks-1.gz", {"Id": "x"}, 1_704_250_000)
    for base in (f"{tmp_path}/{folder}", f"{tmp_path}//{folder}/", f"file:{tmp_path}/{folder}"):
        if "%" in folder and base.startswith("file:"):
            continue
        row = clicks.click_rows(read_click_lines(spark, base, TODAY)).collect()
        assert [r.file_name for r in row] == ["2024/01/03/clicks-1.gz"]


def test_retail_totals_are_exact(table):
    def one(price, tax_rate, rate=4e-9, cost="0.000000000001"):
        owner = {"itemizable_id": 1, "itemizable_type": purchase_orders.ORDER_OWNERS[0]}
        return purchase_orders.retail_totals(
            table("purchase_orders", dict(id=1, type_=purchase_orders.ORDER_OWNERS[0])),
            table("milestones", dict(id=1, total_price=price, tax_rate=tax_rate, **owner)),
            table("shippings", dict(id=1, shipable_id=1, shipable_type=purchase_orders.ORDER_OWNERS[0], cost=cost)),
            table("currencies", dict(id=1, exchangable_id=1, exchangable_type=purchase_orders.ORDER_OWNERS[0], conversion_rate=Decimal("0.000000004"))),
        ).first()

    row = one("1.123456789012", "8.25")
    assert row.retail_subtotal_price == Decimal("1.123456789012")
    assert row.retail_tax_amount == Decimal("1.123456789012") * Decimal("0.0825")
    assert row.retail_total_price == row.retail_subtotal_price + row.retail_tax_amount + Decimal("0.000000000001")
    assert row.retail_total_price_usd == pytest.approx(float(row.retail_total_price) / 4e-9, rel=1e-15)
    with pytest.raises(PySparkException, match="not a decimal"):
        one("1.1234567890123", "8.25")


def test_a_trailing_newline_is_not_the_item(values):
    score = lambda item: checklist_score(F.array(F.lit(item)), {"Create Account": 20})
    assert values(score("Create Account"), score("Create Account\n"), score("\nCreate Account")) == (20, 0, 20)


def test_registering_another_location_is_seen(spark, tmp_path):
    for version, rows in (("v1", 3), ("v2", 7), ("v1", 3)):
        path = f"{tmp_path}/{version}"
        spark.range(rows).write.mode("overwrite").parquet(path)
        register(spark, "pointed_at", path, spark.read.parquet(path).schema)
        assert spark.table("pointed_at").count() == rows
    spark.sql("DROP TABLE pointed_at")


def test_database_names_become_declared_ones(spark):
    taxes = table_schema("taxes")
    names = ["TYPE" if f.name == "type_" else f.name for f in taxes]
    frame = spark.createDataFrame([], ", ".join(f"`{n}` string" for n in names) + ", surplus int")
    assert declared(frame, "taxes").schema.names == taxes.names
    assert [f.dataType for f in declared(frame, "taxes").schema] == [f.dataType for f in taxes]
    with pytest.raises(ValueError, match="has no column"):
        declared(frame.drop("id"), "taxes")
