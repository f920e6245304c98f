from datetime import date, datetime

import pytest

from ledgerloom.plans.catalogue import OUTPUTS, WINDOWED, build
from ledgerloom.publish import publish, publish_all, publish_boosted, publish_clicks, publish_windows
from ledgerloom.schemas import BOOST_SCORES, TABLES, table_schema


@pytest.fixture(scope="module")
def base(spark, table, tmp_path_factory):
    """All source tables, empty but for a few rows."""
    folder = str(tmp_path_factory.mktemp("base"))
    rows = {
        "wares": [dict(id=1, name="a"), dict(id=2)],
        "users": [dict(id=1, uuid="u", sso_attributes="{}")],
        "organizations": [dict(id=1)],
        "events": [
            dict(id=1, event="view", uuid="u", session_id="s", email="e", created_at=datetime(2024, 6, 12)),
            dict(id=2, event="view", uuid="u", session_id="s", created_at=datetime(2024, 6, 13)),
        ],
    }
    for name in TABLES:
        frame = table(name, *rows[name]) if name in rows else spark.createDataFrame([], table_schema(name))
        frame.coalesce(1).write.parquet(f"{folder}/{name}")
    return folder


def test_every_output_builds(spark, base):
    for name in OUTPUTS:
        assert build(spark, name, base).columns


def test_publish(spark, base, tmp_path):
    out = f"{tmp_path}/out"
    (row,) = publish(spark, "wares", base, out).collect()
    assert (row["name"], row["rows"], row["path"]) == ("wares", 2, f"{out}/wares")
    assert spark.read.parquet(row["path"]).count() == 2


def test_one_failure_does_not_stop_the_others(spark, base, tmp_path):
    manifest, errors = publish_all(spark, base, f"{tmp_path}/out", ["wares", "organizations", "users"])
    assert {r["name"]: r["rows"] for r in manifest.collect()} == {"wares": 2, "users": 1}
    assert set(errors) == {"organizations"} and "uuid is null" in errors["organizations"]


@pytest.mark.parametrize("name, expected", [("events", 2), ("embedded_dynamic_forms", 0), ("events_emails", 2)])
def test_publish_windows(spark, base, tmp_path, name, expected):
    today = date(2024, 6, 15)
    for _ in range(2):
        manifest = publish_windows(spark, name, base, f"{tmp_path}/out", today)
        assert sum(r["rows"] for r in manifest.collect()) == expected
    assert len(WINDOWED[name].partition_by) in (1, 3)
    assert spark.read.parquet(f"{tmp_path}/out/{name}").count() == expected


def test_publish_registers_and_repoints(spark, table, tmp_path):
    table("wpcs", *[dict(id=i, ware_id=i, provider_id=1, organization_id=1, booster=1.0) for i in range(3)]).write.parquet(f"{tmp_path}/wpcs")
    scores = spark.createDataFrame([(1, 1, 2, 1, 4.5, "true")], BOOST_SCORES)
    spark.sql("CREATE DATABASE IF NOT EXISTS published")
    for version in ("v1", "v2"):
        (row,) = publish_boosted(spark, scores, str(tmp_path), f"{tmp_path}/out", version, "published").collect()
        assert (row["name"], row["rows"]) == ("wpcs", 3) and row["path"].endswith(version)
    assert sorted(r.booster for r in spark.table("published.wpcs").collect()) == [1.0, 1.0, 4.5]
    spark.sql("DROP DATABASE published CASCADE")


def test_publish_clicks(spark, tmp_path):
    folder = tmp_path / "objects/2024/06/15"
    folder.mkdir(parents=True)
    (folder / "clicks-1.txt").write_text('{"Id": "a"}\n{"Id": "b"}\n')
    for _ in range(2):
        (row,) = publish_clicks(spark, f"{tmp_path}/objects", f"{tmp_path}/out", date(2024, 6, 15)).collect()
        assert (row["name"], row["rows"]) == ("ads_clicks", 2)
