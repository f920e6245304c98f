from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerloom.operators.contracts import Rule, enforce, not_null
from ledgerloom.operators.lookup import (
    SkewPolicy,
    drop_related,
    hot_keys,
    keep_related,
    lookup,
    size_in_bytes,
)
from ledgerloom.operators.paging import page_after, page_at, pages
from ledgerloom.operators.reduce import Satellite, gather, pick_rows

SALTED = SkewPolicy(broadcast_bytes=-1, hot_rows=20)


@pytest.fixture
def skewed(spark):
    """A third of the parents share key 1, a tenth have no key, the rest are spread."""
    rows = spark.range(300).select(
        "id",
        F.when(F.col("id") % 3 == 0, F.lit(1))
        .when(F.col("id") % 10 == 1, F.lit(None).cast("int"))
        .otherwise((F.col("id") % 70).cast("int"))
        .alias("k"),
    )
    children = spark.range(60).select(F.col("id").cast("int").alias("c"), (F.col("id") * 2).alias("v"))
    return rows, children


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_lookup_equals_plain_join(skewed, how):
    parents, children = skewed
    plain = parents.join(children.withColumnRenamed("c", "k"), "k", how)
    columns = parents.columns if how in ("left_semi", "left_anti") else [*parents.columns, "v"]
    salted = lookup(parents, children, {"k": "c"}, how, policy=SALTED)
    assert sorted(salted.columns) == sorted(columns)
    assert sorted(map(str, salted.select(*columns).collect())) == sorted(
        map(str, plain.select(*columns).collect())
    )


def test_salted_lookup_on_two_keys(spark, skewed):
    parents, children = skewed
    parents = parents.withColumn("k2", F.col("k") + 1)
    children = children.withColumn("c2", F.col("c") + 1)
    salted = lookup(parents, children, {"k": "c", "k2": "c2"}, policy=SALTED)
    plain = lookup(parents, children, {"k": "c", "k2": "c2"})
    assert sorted(map(str, salted.collect())) == sorted(map(str, plain.collect()))


def test_hot_key_is_spread(spark, skewed):
    """The hot key's rows land in several partitions of the join, null keys too."""
    parents, children = skewed
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = lookup(parents, children, {"k": "c"}, policy=SkewPolicy(-1, 20))
        parts = rows.withColumn("p", F.spark_partition_id()).groupBy("k").agg(
            F.countDistinct("p").alias("p")
        )
        spread = {r["k"]: r["p"] for r in parts.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert spread[1] > 1 and spread[None] > 1 and spread[2] == 1


def test_hot_keys(skewed):
    parents, _ = skewed
    (hot,) = hot_keys(parents, ["k"], 20).collect()
    rows = parents.where("k = 1").count()
    assert (hot["k"], hot["_salts"]) == (1, -(-rows // 20))


def test_related_rows(spark):
    children = spark.createDataFrame([(1, 10), (2, 20), (3, None), (4, 10)], "id int, owner int")
    owners = spark.createDataFrame([(10,), (30,), (10,)], "oid int")
    for policy in (SkewPolicy(), SkewPolicy(-1, 1)):
        kept = keep_related(children, owners, {"owner": "oid"}, policy=policy)
        gone = drop_related(children, owners, {"owner": "oid"}, policy=policy)
        assert sorted(r["id"] for r in kept.collect()) == [1, 4]
        assert sorted(r["id"] for r in gone.collect()) == [2, 3]


def test_size_settings():
    assert [size_in_bytes(t) for t in ("10485760", "10MB", "64k", "1g", "5b", "-1")] == [
        10485760, 10485760, 65536, 1 << 30, 5, -1,
    ]


def test_pick_rows_and_gather_agree(spark):
    rows = spark.createDataFrame(
        [(1, 7, "a", None), (2, 7, None, 5), (3, 8, "c", 6), (4, None, "d", 9)],
        "id int, owner int, name string, cost int",
    )
    last = {r["owner"]: r for r in pick_rows(rows, ["owner"], "id", "last").collect()}
    first = {r["owner"]: r for r in pick_rows(rows, ["owner"], "id", "first").collect()}
    assert (last[7].id, last[7].name, first[7].id, first[7].cost) == (2, None, 1, None)
    assert set(last) == {7, 8}
    found = gather(
        "key",
        Satellite("l", rows, "owner", ["name", "cost"]),
        Satellite("f", rows, "owner", ["name"], pick="first"),
    )
    got = {r["key"]: r for r in found.collect()}
    assert (got[7].l_id, got[7].l_name, got[7].l_cost, got[7].f_id, got[7].f_name) == (2, None, 5, 1, "a")


def test_gather_marks_missing_children(spark):
    left = spark.createDataFrame([(1, 7, "a")], "id int, owner int, name string")
    right = spark.createDataFrame([(5, 8, Decimal("2.5"))], "id int, owner int, cost decimal(9,2)")
    found = gather("key", Satellite("l", left, "owner", ["name"]), Satellite("r", right, "owner", ["cost"]))
    got = {r["key"]: r.asDict() for r in found.collect()}
    assert got[7]["r_id"] is None and got[8]["l_id"] is None and got[8]["r_cost"] == Decimal("2.50")


@pytest.fixture
def checked(spark):
    rows = spark.createDataFrame([(1, "a", 5), (2, None, 5), (3, None, None)], "id int, name string, n int")
    return rows, [*not_null("name"), Rule("n too small", F.col("n") > 3)]


def run(checked, mode):
    rows, rules = checked
    return enforce(rows, rules, [F.col("id"), F.col("n")], mode).orderBy("id").collect()


def test_contract_splits_rows_exactly(checked):
    assert [r.id for r in run(checked, "valid")] == [1]
    assert [tuple(r) for r in run(checked, "rejects")] == [
        (2, "name is null"), (3, "name is null; n too small"),
    ]
    assert [r.violations for r in run(checked, "flag")] == [
        [], ["name is null"], ["name is null", "n too small"],
    ]


def test_contract_fails_even_when_columns_are_pruned(checked):
    rows, rules = checked
    with pytest.raises(PySparkException, match="contract of row broken for id="):
        enforce(rows, rules, [F.col("id")]).agg(F.count(F.lit(1))).collect()
    with pytest.raises(ValueError, match="mode"):
        enforce(rows, rules, [F.col("id")], "maybe")


def test_contract_passes_clean_rows(checked):
    rows, rules = checked
    assert enforce(rows.where("id = 1"), rules, [F.col("id")]).count() == 1


def test_pages(spark):
    rows = spark.range(250).withColumnRenamed("id", "k")
    assert [p.count() for p in pages(rows, "k")] == [100, 100, 50]
    assert [r.k for r in page_after(rows, "k", 248).collect()] == [249]
    assert [r.k for r in page_at(rows, "k", 2, 3).orderBy("k").collect()] == [6, 7, 8]
    assert page_at(rows, "k", 3).count() == 0
