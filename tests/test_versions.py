"""Staged replacement, versions of files, catalog re-pointing and the ledger of objects."""

import gzip
import json
import os
from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerloom.operators.lookup import SkewPolicy
from ledgerloom.plans.boost import KEY
from ledgerloom.plans.clicks import unseen_clicks
from ledgerloom.schemas import BOOST_SCORES
from ledgerloom.sinks import staged, versions
from ledgerloom.sinks.catalog import register
from ledgerloom.sinks.parquet import write_snapshot
from ledgerloom.sinks.upsert import boost_files, repeated_keys, stored_clicks
from ledgerloom.streaming.ledger import ingest_click_days, ingest_new_objects, ledger_rows, new_objects


def ids(frame):
    return sorted(r.id for r in frame.select("id").collect())


def test_a_failed_snapshot_leaves_the_old_rows(spark, tmp_path):
    path = f"{tmp_path}/t"
    write_snapshot(spark.range(5), path)
    bad = spark.range(100).repartition(8).select(F.when(F.col("id") < 90, F.col("id")).otherwise(F.raise_error(F.lit("half-way")).cast("long")).alias("id"))
    reader = spark.read.parquet(path)
    with pytest.raises(PySparkException, match="half-way"):
        write_snapshot(bad, path)
    assert ids(reader) == ids(spark.read.parquet(path)) == [0, 1, 2, 3, 4]
    assert os.listdir(tmp_path) == ["t"]
    # A snapshot may be made of the data set it replaces.
    row = write_snapshot(spark.read.parquet(path).where("id > 2"), path).first()
    assert row.rows == 2 and ids(spark.read.parquet(path)) == [3, 4] and os.listdir(tmp_path) == ["t"]
    assert write_snapshot(spark.range(0), path).first().rows == 0 and spark.read.parquet(path).columns == ["id"]


def test_lost_rows_are_noticed(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    write_snapshot(spark.range(5), path)
    reading = type(spark.read)
    whole = reading.parquet
    with monkeypatch.context() as m:
        m.setattr(reading, "parquet", lambda self, *p, **o: whole(self, *p, **o).limit(1))
        with pytest.raises(staged.IncompleteWrite):
            write_snapshot(spark.range(9), path)
    assert ids(spark.read.parquet(path)) == [0, 1, 2, 3, 4]


def test_a_run_that_died_between_its_renames_is_undone(spark, tmp_path):
    path = f"{tmp_path}/t"
    write_snapshot(spark.range(3), path)
    assert not staged.restore_folder(spark, path)
    os.rename(path, f"{path}{staged.REPLACED}x")
    assert staged.restore_folder(spark, path) and ids(spark.read.parquet(path)) == [0, 1, 2]
    assert not staged.restore_folder(spark, f"{tmp_path}/none")


def test_repointing_keeps_the_table(spark, tmp_path):
    for v in (1, 2):
        spark.range(v).write.parquet(f"{tmp_path}/v{v}")
    spark.sql("DROP TABLE IF EXISTS pointed")
    register(spark, "pointed", f"{tmp_path}/v1", spark.range(1).schema)
    spark.sql("ALTER TABLE pointed SET TBLPROPERTIES ('mark' = 'kept')")
    register(spark, "pointed", f"{tmp_path}/v2", spark.range(1).schema)
    assert ids(spark.table("pointed")) == [0, 1]
    assert spark.sql("SHOW TBLPROPERTIES pointed ('mark')").first()["value"] == "kept"
    spark.sql("DROP TABLE pointed")


def test_only_named_partitions_are_added(spark, tmp_path):
    path = f"{tmp_path}/p"
    rows = spark.createDataFrame([(1, "it's", 2023), (2, "y", 2024)], "id long, dt string, year int")
    rows.write.partitionBy("dt", "year").parquet(path)
    spark.sql("DROP TABLE IF EXISTS named")
    register(spark, "named", path, rows.schema, ["dt", "year"], [])
    assert ids(spark.table("named")) == [1, 2]
    more = spark.createDataFrame([(3, "a'b", 2025), (4, "unnamed", 2025)], rows.schema)
    more.write.mode("append").partitionBy("dt", "year").parquet(path)
    register(spark, "named", path, rows.schema, ["dt", "year"], [{"dt": "a'b", "year": 2025}])
    assert ids(spark.table("named")) == [1, 2, 3]
    register(spark, "named", path, rows.schema, ["dt", "year"])
    assert ids(spark.table("named")) == [1, 2, 3, 4]
    spark.sql("DROP TABLE named")


@pytest.fixture
def wpcs(table):
    return table("wpcs", *[dict(id=i, ware_id=i // 10, organization_id=1, provider_id=2, booster=1.0) for i in range(80)])


def score(ware, value=4.5, update="true"):
    return (ware, 1, ware, 2, value, update)


def test_only_changed_files_are_rewritten(spark, wpcs, tmp_path):
    path = f"{tmp_path}/wpcs"
    first = versions.write_full(wpcs.repartitionByRange(8, "ware_id"), path)
    assert (first.version, first.files, first.rows) == (1, 8, 80)
    scores = spark.createDataFrame([score(3), score(5, 9.0, "false"), score(99)], BOOST_SCORES)
    second = boost_files(spark, scores, path)
    assert (second.version, second.rows, second.parent) == (2, 80, first.id)
    before, after = ({r.file for r in versions.version_files(spark, path, v).collect()} for v in (first, second))
    assert len(before - after) == 1 and len(before & after) == 7
    found = versions.read_version(spark, path, wpcs.schema)
    assert {r.id: r.booster for r in found.collect()} == {i: 4.5 if i // 10 == 3 else 1.0 for i in range(80)}
    assert {r.booster for r in versions.read_version(spark, path, wpcs.schema, 1).collect()} == {1.0}
    # The same scores again change nothing, so there is no new version.
    assert boost_files(spark, scores, path).version == 2
    assert [r.version for r in versions.versions(spark, path).orderBy("version").collect()] == [1, 2]


def test_a_rewrite_must_keep_the_rows_and_the_first_of_two_wins(spark, wpcs, tmp_path):
    path = f"{tmp_path}/w"
    with pytest.raises(FileNotFoundError):
        versions.read_version(spark, path, wpcs.schema)
    versions.write_full(wpcs, path)
    with pytest.raises(staged.IncompleteWrite):
        versions.rewrite_files(spark, path, wpcs.schema, lambda d: d.where("id = 3"), lambda d: d.where("id <> 3"))
    assert versions.current(spark, path).version == 1 and versions.read_version(spark, path, wpcs.schema).count() == 80
    # Another run commits the same number with a smaller id in between.
    taken = spark.createDataFrame([(2, "0", None, 0, 0, 0)], versions.VERSION)

    def slow(rows):
        taken.coalesce(1).write.mode("append").json(f"{path}/versions")
        spark.createDataFrame([], "file string, rows long, bytes long").coalesce(1).write.parquet(f"{path}/lists/0")
        return rows

    with pytest.raises(versions.ConcurrentWrite):
        versions.rewrite_files(spark, path, wpcs.schema, lambda d: d.where("id = 3"), slow)
    assert versions.current(spark, path).id == "0" and versions.read_version(spark, path, wpcs.schema).count() == 0


def test_touched_files_are_found_by_key_and_value_only(spark, wpcs, tmp_path, capsys):
    wpcs.write.parquet(f"{tmp_path}/w")
    from ledgerloom.plans.boost import changed_rows

    scores = spark.createDataFrame([score(3)], BOOST_SCORES)
    changed_rows(spark.read.schema(wpcs.schema).parquet(f"{tmp_path}/w"), scores).select(F.lit(1)).explain()
    plan = capsys.readouterr().out
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line)
    assert all(c in scan.split("ReadSchema")[1] for c in (*KEY, "booster")) and "created_at" not in scan.split("ReadSchema")[1]


def put(base, key, *lines, day=None):
    path = f"{base}/{key}"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with gzip.open(path, "wt") as out:
        out.writelines(json.dumps(line) + "\n" for line in lines)
    if day:
        stamp = datetime(*day).timestamp()
        os.utime(path, (stamp, stamp))


@pytest.mark.parametrize("per_batch", [1, 10_000])
def test_ledger_takes_every_object_once(spark, tmp_path, per_batch):
    base, target, ledger = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/ledger"

    def run(day, days=5):
        return ingest_new_objects(spark, base, date(2024, 1, day), target, ledger, days, objects_per_batch=per_batch)

    def stored():
        return sorted(r.id.strip('"') for r in stored_clicks(spark, target).collect())

    assert run(1) == 0 and ledger_rows(spark, ledger).count() == 0
    put(base, "2024/01/03/clicks-1.gz", {"Id": "a"}, {"Id": "a"}, {"Id": "b"})
    put(base, "2024/01/03/clicks [x]{1}*.gz", {"Id": "c d"})
    put(base, "2024/01/03/skip.gz", {"Id": "no"})
    assert (run(3), run(3), stored()) == (2, 0, ["a", "b", "c d"])
    # A late object in an old folder and a rewritten one are taken once, one outside the listed days is not.
    put(base, "2024/01/02/clicks-0.gz", {"Id": "late"})
    put(base, "2023/11/02/clicks-0.gz", {"Id": "old"})
    put(base, "2024/01/03/clicks-1.gz", {"Id": "a"}, {"Id": "b"}, {"Id": "again"}, {"Id": "x"})
    put(base, "2024/01/04/clicks-2.gz", {"Id": "new"})
    assert (run(4), run(4)) == (3, 0)
    assert stored() == ["a", "again", "b", "c d", "late", "new", "x"]
    assert run(4, days=70) == 1 and "old" in stored()
    assert sorted(os.listdir(ledger))[-4:] == [f"day={d}" for d in ("2023-11-02", "2024-01-02", "2024-01-03", "2024-01-04")]


def test_a_batch_that_was_stored_but_not_entered_is_taken_again(spark, tmp_path, monkeypatch):
    base, target, ledger = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/ledger"
    put(base, "2024/01/03/clicks-1.gz", {"Id": "a"})
    args = (spark, base, date(2024, 1, 3), target, ledger)
    ingest_new_objects(*args[:-1], f"{tmp_path}/lost")
    assert ingest_new_objects(*args) == 1 and stored_clicks(spark, target).count() == 1


def test_ledger_listing_is_bounded_by_days(spark, tmp_path, capsys):
    base, ledger = f"{tmp_path}/in", f"{tmp_path}/ledger"
    for day in range(1, 9):
        put(base, f"2024/01/{day:02}/clicks.gz", {"Id": str(day)})
    assert ingest_new_objects(spark, base, date(2024, 1, 8), f"{tmp_path}/out", ledger, days=8) == 8
    put(base, "2024/01/08/clicks-2.gz", {"Id": "z"})
    waiting = new_objects(spark, base, date(2024, 1, 8), ledger, days=2)
    assert [r.key for r in waiting.collect()] == ["2024/01/08/clicks-2.gz"]
    waiting.explain()
    plan = capsys.readouterr().out
    assert "PartitionFilters: [day" in plan and "2024-01-07" in plan and "2024-01-06" not in plan


def test_day_streams_keep_their_checkpoints(spark, tmp_path):
    base, target, state = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state"
    put(base, "2024/01/03/clicks-1.gz", {"Id": "a"}, {"Id": "b"})
    assert ingest_click_days(spark, base, target, state, date(2024, 1, 3), 2) == ["2024/01/02", "2024/01/03"]
    put(base, "2024/01/03/clicks-0.gz", {"Id": "late"})
    put(base, "2024/01/04/clicks-1.gz", {"Id": "b"}, {"Id": "c"})
    assert ingest_click_days(spark, base, target, state, date(2024, 1, 4), 2) == ["2024/01/03", "2024/01/04"]
    assert sorted(r.id for r in stored_clicks(spark, target).collect()) == ['"a"', '"b"', '"c"', '"late"']
    assert sorted(os.listdir(state)) == ["2024-01-02", "2024-01-03", "2024-01-04"]


def test_a_small_batch_does_not_move_the_stored_keys(spark, table, tmp_path):
    old = table("clicks", *[dict(id=f"i{i}", year=2024, data="old") for i in range(50)])
    old.write.parquet(f"{tmp_path}/s")
    stored = spark.read.schema(old.schema).parquet(f"{tmp_path}/s")
    new = table("clicks", *[dict(id=f"i{i}", year=2024, data="new") for i in range(45, 60)])
    new.write.parquet(f"{tmp_path}/n")
    new = spark.read.schema(old.schema).parquet(f"{tmp_path}/n")
    small, large = repeated_keys(new, stored), repeated_keys(new, stored, SkewPolicy(broadcast_bytes=-1))
    assert sorted(r.id for r in small.collect()) == [f"i{i}" for i in range(45, 50)] and large.count() == 50
    plan = small._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    for keys in (small, large):
        assert sorted(r.id for r in unseen_clicks(new, keys).collect()) == [f"i{i}" for i in range(50, 60)]
