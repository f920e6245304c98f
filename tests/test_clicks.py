import gzip
import json
import os
from datetime import UTC, date, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerloom.plans import clicks
from ledgerloom.sinks.upsert import (
    create_click_table,
    ingest_recent_clicks,
    insert_new_clicks,
    insert_new_clicks_into,
    stored_clicks,
)
from ledgerloom.sources.objects import day_folders, list_objects, read_click_lines
from ledgerloom.streaming.clicks import (
    distinct_recent_clicks,
    ingest_click_folder,
    stream_click_lines,
)

TODAY = date(2024, 1, 3)
STAMP = datetime(2024, 1, 3, 4, 5, 6).timestamp()


def put(base, key, *records, stamp=STAMP):
    path = base / key
    path.parent.mkdir(parents=True, exist_ok=True)
    body = "\n".join(r if isinstance(r, str) else json.dumps(r) for r in records) + "\n"
    path.write_bytes(gzip.compress(body.encode()))
    os.utime(path, (stamp, stamp))


def test_day_folders():
    assert day_folders(TODAY) == ["2024/01/03", "2024/01/02", "2024/01/01", "2023/12/31", "2023/12/30"]


def test_only_click_objects_of_the_last_days(spark, tmp_path):
    put(tmp_path, "2024/01/03/07/clicks-1.gz", {"Id": "a"}, {"Id": "b"})
    put(tmp_path, "2023/12/30/clicks/part.gz", {"Id": "c"})
    put(tmp_path, "2023/12/29/clicks-old.gz", {"Id": "old"})
    # Not a gzip file at all: the name filter drops it before it is read.
    (tmp_path / "2024/01/03/impressions.gz").write_bytes(b"not gzip")
    rows = clicks.click_rows(read_click_lines(spark, str(tmp_path), TODAY))
    got = {r.id: r for r in rows.collect()}
    assert set(got) == {'"a"', '"b"', '"c"'}
    assert got['"a"'].file_name == "2024/01/03/07/clicks-1.gz"
    assert got['"c"'].file_name == "2023/12/30/clicks/part.gz"
    assert got['"a"'].last_modified_date == datetime.fromtimestamp(STAMP, UTC).replace(tzinfo=None) and got['"a"'].year == 2024


def test_no_folder_at_all(spark, tmp_path):
    assert read_click_lines(spark, str(tmp_path), TODAY).count() == 0
    ingest_recent_clicks(spark, str(tmp_path), TODAY, f"{tmp_path}/out")


def test_ids_are_json_text(spark, tmp_path):
    put(tmp_path, "2024/01/03/clicks.gz", {"Id": 7}, {"Other": 1}, {"Id": None})
    rows = clicks.click_rows(read_click_lines(spark, str(tmp_path), TODAY))
    assert sorted(r.id for r in rows.collect()) == ["7", "null", "null"]


def test_bad_line_stops_the_job(spark, tmp_path):
    put(tmp_path, "2024/01/03/clicks.gz", {"Id": "a"}, "{oops")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        clicks.click_rows(read_click_lines(spark, str(tmp_path), TODAY)).collect()


def test_ingest_is_idempotent(spark, tmp_path):
    source, target = tmp_path / "in", f"{tmp_path}/out"
    put(source, "2024/01/03/clicks-1.gz", {"Id": "a", "n": 1}, {"Id": "a", "n": 2}, {"Id": "b"})
    last_year = datetime(2023, 12, 31, 1).timestamp()
    put(source, "2023/12/31/clicks-0.gz", {"Id": "a"}, stamp=last_year)
    for _ in range(2):
        ingest_recent_clicks(spark, str(source), TODAY, target)
        got = sorted((r.id, r.year) for r in stored_clicks(spark, target).collect())
        assert got == [('"a"', 2023), ('"a"', 2024), ('"b"', 2024)]
    put(source, "2024/01/03/clicks-2.gz", {"Id": "b"}, {"Id": "c"})
    ingest_recent_clicks(spark, str(source), TODAY, target)
    assert stored_clicks(spark, target).count() == 4


def test_first_click_is_the_earliest(table):
    rows = table(
        "clicks",
        dict(id="x", year=2024, data="3", file_name="b", last_modified_date=datetime(2024, 1, 1)),
        dict(id="x", year=2024, data="2", file_name="a", last_modified_date=datetime(2024, 1, 1)),
        dict(id="x", year=2024, data="1", file_name="a", last_modified_date=datetime(2024, 1, 2)),
    )
    assert [r.data for r in clicks.first_clicks(rows).collect()] == ["2"]


def test_hot_id_is_reduced_before_the_shuffle(spark, table, tmp_path):
    rows = table("clicks", *[dict(id="hot", year=2024, data=str(i)) for i in range(50)])
    insert_new_clicks(rows.repartition(8), f"{tmp_path}/out")
    assert stored_clicks(spark, f"{tmp_path}/out").count() == 1


RECORD = {
    "Id": "i1", "Meta:schema": "click", "BurnIn": True, "Device": {"kind": "phone"}, "PassId": "12",
    "SiteId": 3, "CreatedOn": "/Date(1609459200123)/", "EventCreatedOn": 1609459200456,
    "ImpressionCreatedOn": None, "DataCenter": "off", "Price": 1.5, "Keywords": "a,b",
    "TimeZoneId": "UTC", "User": {"Key": "k", "IsNew": False, "Type": 4}, "Unknown": [1],
}


def test_flat_clicks(table):
    rows = table("clicks", dict(id="x", data=json.dumps(RECORD), year=2021), dict(id="y", data="{}"))
    flat = clicks.flat_clicks(rows)
    assert len(flat.columns) == 40 and tuple(flat.columns) == clicks.FLAT_COLUMNS
    got = {r.year: r for r in flat.collect()}
    row = got[2021]
    assert (row.id, row.metaschema, row.burnin, row.passid, row.siteid) == ("i1", "click", True, 12, 3)
    assert (row.device, row.datacenter, row.price) == ('{"kind":"phone"}', False, "1.5")
    assert row.created_on == datetime(2021, 1, 1, 0, 0, 0, 123000)
    assert row.eventcreatedon == datetime(2021, 1, 1, 0, 0, 0, 456000)
    assert row.impressioncreatedon is None
    assert (row.user_key, row.user_is_new, row.user_type) == ("k", False, 4)
    assert all(v is None for k, v in got[0].asDict().items() if k != "year")


def test_flat_clicks_reject_bad_numbers(table):
    rows = table("clicks", dict(id="x", data='{"SiteId": "abc"}'))
    with pytest.raises(PySparkException, match="CAST_INVALID_INPUT"):
        clicks.flat_clicks(rows).collect()


def test_stream_equals_batch(spark, tmp_path):
    source, target = tmp_path / "in", f"{tmp_path}/out"
    put(source, "2024/01/03/clicks-1.gz", RECORD, {"Id": "b"}, RECORD)
    put(source, "2024/01/03/skip.gz", {"Id": "s"})

    def run():
        ingest_click_folder(spark, str(source), target, f"{tmp_path}/cp").awaitTermination()
        return sorted((r.id, r.file_name) for r in stored_clicks(spark, target).collect())

    assert run() == [('"b"', "2024/01/03/clicks-1.gz"), ('"i1"', "2024/01/03/clicks-1.gz")]
    assert len(run()) == 2
    put(source, "2024/01/03/clicks-2.gz", {"Id": "b"}, {"Id": "n"})
    assert [i for i, _ in run()] == ['"b"', '"i1"', '"n"']

    batch_target = f"{tmp_path}/batch"
    ingest_recent_clicks(spark, str(source), TODAY, batch_target)
    columns = ["id", "data", "file_name", "last_modified_date", "year"]
    flat_stream = clicks.flat_clicks(stored_clicks(spark, target).select(columns))
    flat_batch = clicks.flat_clicks(stored_clicks(spark, batch_target).select(columns))
    assert flat_stream.exceptAll(flat_batch).count() == 0 == flat_batch.exceptAll(flat_stream).count()


def test_flatten_runs_on_a_stream(spark, tmp_path):
    put(tmp_path, "2024/01/03/clicks-1.gz", RECORD)
    stream = clicks.flat_clicks(clicks.click_rows(stream_click_lines(spark, str(tmp_path))))
    assert stream.isStreaming
    query = stream.writeStream.format("memory").queryName("flat").trigger(availableNow=True).start()
    query.awaitTermination()
    assert [r.siteid for r in spark.table("flat").collect()] == [3]


def test_bounded_state_dedupe(spark, tmp_path):
    put(tmp_path, "2024/01/03/clicks-1.gz", {"Id": "a"}, {"Id": "a"}, {"Id": "b"})
    stream = distinct_recent_clicks(clicks.click_rows(stream_click_lines(spark, str(tmp_path))))
    query = stream.writeStream.format("memory").queryName("recent").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(r.id for r in spark.table("recent").collect()) == ['"a"', '"b"']


def test_high_water_marks(spark, table):
    rows = table("clicks", *[dict(id=str(d), last_modified_date=datetime(2024, 1, d)) for d in (3, 9, 4)])
    empty = table("clicks")
    assert clicks.high_water_mark(rows).first().last_date == datetime(2024, 1, 9)
    assert clicks.high_water_mark(empty).first().last_date is None
    marks = clicks.high_water_marks({"clicks": rows, "decisions": empty}).collect()
    assert {m.table_name: m.last_date for m in marks} == {"clicks": datetime(2024, 1, 9), "decisions": None}


def test_listing(spark, tmp_path):
    put(tmp_path, "2024/01/03/clicks-1.gz", {"Id": "a"})
    put(tmp_path, "2024/01/02/other.gz", {"Id": "a"})
    listed = list_objects(spark, str(tmp_path))
    assert listed.columns == ["path", "modificationTime", "length"] and listed.count() == 2
    assert listed.where(F.col("length") > 0).count() == 2
    assert list_objects(spark, str(tmp_path), "clicks*").count() == 1


def test_bucketed_insert(spark, table, tmp_path):
    create_click_table(spark, "t_click_store", f"{tmp_path}/t", 4)
    rows = table("clicks", *[dict(id=f"i{i % 7}", year=2023 + i % 2, data=str(i)) for i in range(40)])
    for _ in range(2):
        insert_new_clicks_into(rows, "t_click_store", 4)
        assert spark.table("t_click_store").count() == 14
    more = table("clicks", dict(id="i0", year=2023, data="x"), dict(id="new", year=2025, data="y"))
    insert_new_clicks_into(more, "t_click_store", 4)
    assert spark.table("t_click_store").count() == 15
    assert spark.table("t_click_store").where("data = 'x'").count() == 0
    spark.sql("DROP TABLE t_click_store")
