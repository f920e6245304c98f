from decimal import Decimal

import pytest
from pyspark.errors import PySparkException

from ledgerloom.plans.boost import boosted, one_score_per_key
from ledgerloom.plans.snapshots import snapshot
from ledgerloom.schemas import BOOST_SCORES
from ledgerloom.sinks.catalog import register
from ledgerloom.sinks.parquet import dataset_path, manifest_totals, row_count, write_snapshot
from ledgerloom.sinks.upsert import write_boosted
from ledgerloom.sources.scores import read_scores_csv, read_scores_table
from ledgerloom.sources.tables import jdbc_options, read_table


def wpc(id, ware, provider, organization, booster=1.0):
    return dict(
        id=id, ware_id=ware, provider_id=provider, organization_id=organization, booster=booster
    )


@pytest.fixture
def scores(spark):
    def build(*rows):
        return spark.createDataFrame(list(rows), BOOST_SCORES)

    return build


def test_boost(table, scores):
    wpcs = table("wpcs", wpc(1, 1, 2, 3), wpc(2, 9, 9, 9), wpc(3, 4, 5, 6), wpc(4, 1, 2, 3), wpc(5, 1, 2, None))
    updates = scores((1, 3, 1, 2, 2.345, "true"), (2, 6, 4, 5, 7.0, "false"))
    out = boosted(wpcs, updates)
    assert out.columns == wpcs.columns
    assert {r.id: r.booster for r in out.collect()} == {1: 2.35, 2: 1.0, 3: 1.0, 4: 2.35, 5: 1.0}


def test_boost_must_fit_and_be_unique(table, scores):
    wpcs = table("wpcs", wpc(1, 1, 2, 3))
    with pytest.raises(PySparkException, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        boosted(wpcs, scores((1, 3, 1, 2, 10.0, "true"))).collect()
    twice = scores((1, 3, 1, 2, 1.0, "true"), (2, 3, 1, 2, 1.0, "true"))
    with pytest.raises(PySparkException, match="score key repeated: 1,3,2"):
        boosted(wpcs, twice).collect()
    with pytest.raises(PySparkException, match="score without ware_id"):
        boosted(wpcs, scores((1, 3, None, 2, 1.0, "true"))).collect()
    # Scores that are not for update do not count.
    assert boosted(wpcs, scores((1, 3, 1, 2, 99.0, "false"))).first().booster == 1.0


def test_scores_keep_two_decimals(scores):
    from ledgerloom.plans.boost import accepted_scores

    row = one_score_per_key(accepted_scores(scores((1, 3, 1, 2, 0.125, "true")))).first()
    assert row["_boost"] == Decimal("0.13")


def test_versioned_write_back(spark, table, scores, tmp_path):
    wpcs = table("wpcs", wpc(1, 1, 2, 3))
    first = write_boosted(wpcs, scores((1, 3, 1, 2, 2.0, "true")), str(tmp_path), "1")
    second = write_boosted(spark.read.parquet(first), scores((1, 3, 1, 2, 3.0, "true")), str(tmp_path), "2")
    assert spark.read.parquet(first).first().booster == 2.0
    assert spark.read.parquet(second).first().booster == 3.0
    with pytest.raises(PySparkException):
        write_boosted(wpcs, scores(), str(tmp_path), "2")


def test_score_sources(spark, tmp_path):
    (tmp_path / "s.csv").write_text(
        "id,organization_id,ware_id,provider_id,updated_booster,update\n1,3,1,2,2.5,true\n"
    )
    rows = read_scores_csv(spark, f"{tmp_path}/s.csv")
    assert tuple(rows.first()) == (1, 3, 1, 2, 2.5, "true")
    rows.createOrReplaceTempView("updated_booster")
    assert read_scores_table(spark).count() == 1


def test_snapshot_manifest_and_catalog(spark, table, tmp_path):
    path = dataset_path(str(tmp_path), "wares")
    rows = snapshot("wares", table("wares", dict(id=1, name="a"), dict(id=2)))
    manifest = write_snapshot(rows, path)
    got = manifest.first()
    assert (got.path, got.rows) == (path, 2) and got.bytes > 0 and got.files >= 1
    assert row_count(spark, path) == 2
    names = [f.name for f in (tmp_path / "wares").iterdir() if f.name.endswith(".parquet")]
    assert all(".gz." in n for n in names)
    register(spark, "t_wares", path, rows.schema)
    assert spark.table("t_wares").count() == 2
    write_snapshot(snapshot("wares", table("wares", dict(id=3))), path)
    register(spark, "t_wares", path, rows.schema)
    assert [r.id for r in spark.table("t_wares").collect()] == [3]
    fewer = rows.select("id")
    register(spark, "t_wares", path, fewer.schema)
    assert spark.table("t_wares").columns == ["id"]
    assert manifest_totals(manifest.unionByName(manifest)).first().rows == 4


def test_partitioned_table_is_recovered(spark, tmp_path):
    path = f"{tmp_path}/p"
    rows = spark.createDataFrame([(1, "x"), (2, "y")], "id int, dt string")
    rows.write.partitionBy("dt").parquet(path)
    register(spark, "t_parts", path, rows.schema, ["dt"])
    assert spark.table("t_parts").where("dt = 'y'").count() == 1
    spark.createDataFrame([(3, "z")], "id int, dt string").write.mode("append").partitionBy("dt").parquet(path)
    register(spark, "t_parts", path, rows.schema, ["dt"])
    assert spark.table("t_parts").count() == 3


def test_declared_table_scan(spark, table, tmp_path):
    table("wares", dict(id=1, name="a")).write.parquet(f"{tmp_path}/wares")
    rows = read_table(spark, str(tmp_path), "wares")
    assert rows.first().name == "a" and "ware_type" in rows.columns


def test_database_scan_options():
    options = jdbc_options("jdbc:postgresql://db/app", "orders", "id", 0, 1000, 16)
    assert options["partitionColumn"] == "id" and options["numPartitions"] == "16"
    assert options["fetchsize"] == "5000"
