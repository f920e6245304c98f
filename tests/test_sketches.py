"""The heavy-hitter sketch of several foreign keys: its estimates, its plans and unchanged results."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import lookup as lookups_module
from ledgerloom.operators.lookup import Lookup, SkewPolicy, hot_keys, lookups, sketched_hot_keys
from ledgerloom.operators.paging import page_index, page_of, pages
from ledgerloom.plans import purchase_orders
from ledgerloom.session import widened_shuffles

SALTED = SkewPolicy(broadcast_bytes=-1, hot_rows=20)


@pytest.fixture
def parents(spark):
    """Two foreign keys with a hot value each, nulls and types of their own."""
    n = F.col("id")
    hot = F.when(n % 3 == 0, 1).when(n % 10 == 1, F.lit(None).cast("int")).otherwise((n % 70).cast("int"))
    text = F.when(n % 4 < 2, F.lit("x, {y}")).when(n % 7 == 0, F.lit(None)).otherwise(n.cast("string"))
    return spark.range(600).repartition(5).select("id", hot.alias("a"), text.alias("b"), (n % 2).alias("wide"))


def rows(frame):
    return sorted(map(str, frame.collect()))


def test_sketch_equals_counts_where_all_keys_are_tracked(parents):
    found = sketched_hot_keys(parents, ["a", "b"], 20)
    for key in ("a", "b"):
        counted = hot_keys(parents, [key], 20)
        assert rows(found[key]) == rows(counted) != []
        assert found[key].dtypes == counted.dtypes


def test_sketch_of_an_empty_frame(parents):
    assert [f.count() for f in sketched_hot_keys(parents.limit(0), ["a", "b"], 1).values()] == [0, 0]


@pytest.mark.parametrize("tracked", [16, 65_536])
def test_lookups_are_the_same_whatever_the_sketch_finds(spark, parents, monkeypatch, tracked):
    monkeypatch.setattr(lookups_module, "TRACKED", tracked)
    monkeypatch.setattr(lookups_module, "SKETCHED", min(tracked, 10_000))
    a = spark.range(60).select(F.col("id").cast("int").alias("_a"), (F.col("id") * 2).alias("va"))
    b = spark.createDataFrame([("x, {y}", 1), ("7", 2), ("11", 3)], "_b string, vb int")
    wanted = [Lookup(a, {"a": "_a"}), Lookup(b, {"b": "_b"})]
    plain = parents.join(a, F.col("a") == F.col("_a"), "left").join(b, F.col("b") == F.col("_b"), "left")
    found = lookups(parents, wanted, parents, policy=SALTED)
    assert rows(found.select("id", "a", "b", "va", "vb")) == rows(plain.select("id", "a", "b", "va", "vb"))


def test_orders_are_read_three_times_at_most(spark, table, tmp_path, capsys):
    names = ("purchase_orders", "currencies", "shippings", "taxes", "providers", "action_items")
    for n in names:
        table(n).write.parquet(f"{tmp_path}/{n}")
    frames = [spark.read.schema(table(n).schema).parquet(f"{tmp_path}/{n}") for n in names]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        purchase_orders.purchase_order_report(*frames).explain()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    plan = capsys.readouterr().out
    reads = [line for line in plan.splitlines() if "FileScan" in line and f"{tmp_path}/purchase_orders" in line]
    assert len(reads) <= 3 and plan.count("ReusedExchange") >= 5
    assert "approx_top_k" in plan


def test_page_index_over_many_partitions(spark, tmp_path, capsys):
    spark.range(1037).select((F.col("id") * 3 + 5).alias("k"), F.lit("x").alias("v")).repartition(9).write.parquet(f"{tmp_path}/t")
    frame = spark.read.parquet(f"{tmp_path}/t")
    index = page_index(frame, "k", f"{tmp_path}/keys", 100)
    found = sorted(tuple(r) for r in index.collect())
    assert found == [(p, p * 300 + 5, min(p * 300 + 302, 3113), 100 if p < 10 else 37) for p in range(11)]
    # One sort of the keys: the index reads what was written, and nothing else is sorted by the key.
    assert spark.read.parquet(f"{tmp_path}/keys").columns == ["key", "part", "place"]
    page_of(frame, "k", index.where("page = 3").first()).explain()
    assert "PushedFilters: [IsNotNull(k), GreaterThanOrEqual(k,905), LessThanOrEqual(k,1202)]" in capsys.readouterr().out
    got = [[r.k for r in p.collect()] for p in pages(frame, "k", 100, f"{tmp_path}/again")]
    assert [k for p in got for k in p] == [i * 3 + 5 for i in range(1037)] and len(got) == 11
    assert list(pages(frame.limit(0), "k", 100, f"{tmp_path}/none")) == []


def test_shuffle_width_is_bounded_and_put_back(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    with pytest.raises(ZeroDivisionError), widened_shuffles(spark, 100 << 40):
        assert spark.conf.get(key) == "20000"
        1 / 0
    with widened_shuffles(spark, 1):
        assert spark.conf.get(key) == before
    assert spark.conf.get(key) == before
