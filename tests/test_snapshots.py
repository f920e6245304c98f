from datetime import datetime

import pytest
from pyspark.errors import PySparkException

from ledgerloom.operators.project import project
from ledgerloom.plans.snapshots import SNAPSHOTS, address_lines, snapshot
from ledgerloom.schemas import TABLES, table_schema


def one(frame):
    (row,) = frame.collect()
    return row


def test_every_snapshot_plans_on_its_declared_table(spark):
    for name, spec in SNAPSHOTS.items():
        empty = spark.createDataFrame([], table_schema(spec.table))
        for mode in ("fail", "valid"):
            assert tuple(snapshot(name, empty, mode).columns) == tuple(spec.columns)


def test_schemas_parse(spark):
    assert len(TABLES) == 26
    for name in TABLES:
        assert len(table_schema(name)) >= 5


def test_schema_driven_projection(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(1, "a", 2)], "id int, name string, spare int")
    got = project(rows, ["name", "id"], {"name": F.upper("name")})
    assert got.columns == ["name", "id"] and one(got).name == "A"


def test_user_references(table):
    fields = r'{"email": null, "company": "a\"b", "last_name": "L", "extra": 1}'
    rows = table(
        "refs",
        dict(id=1, type_="Pg::UserRef", fields=fields),
        dict(id=2, type_="Pg::Other", fields=fields),
    )
    row = one(snapshot("refs_users", rows))
    assert (row.location, row.email, row.company, row.last_name) == ("", "null", "a\\b", "L")
    assert row.created_at == datetime(2020, 11, 26) == row.updated_at
    with pytest.raises(PySparkException, match="fields is null"):
        snapshot("refs_users", table("refs", dict(id=1, type_="Pg::UserRef"))).collect()


def test_provider_references_take_all_types(table):
    rows = table(
        "refs",
        dict(id=1, type_="Pg::UserRef", fields='{"name": "N", "score": [4.5, 1]}'),
        dict(id=2, type_="x", fields=None),
    )
    got = {r.id: r for r in snapshot("refs_providers", rows).collect()}
    assert (got[1].name, got[1].slug, got[1].score) == ('"N"', None, 4.5)
    assert got[2].name is None and got[2].score is None


def test_users(table):
    rows = table(
        "users",
        dict(id=1, uuid="u", first_name="A", sso_attributes='{"email":  "x@y"}', active=True),
        dict(id=2, uuid="u", sso_attributes="{}"),
    )
    got = {r.id: r for r in snapshot("users", rows).collect()}
    assert (got[1].user_sso_email, got[1].sso_attributes) == ('"x@y"', '{"email":"x@y"}')
    assert (got[1].full_name, got[1].active, got[2].user_sso_email) == ("A", "true", "null")
    with pytest.raises(PySparkException, match="sso_attributes is null"):
        snapshot("users", table("users", dict(id=3, uuid="u"))).collect()


def test_milestone_placeholders(table):
    row = one(snapshot("milestones", table("milestones", dict(id=1, classifications="{}", type_="T"))))
    assert row.created_at == row.cancelled_at == datetime(1, 1, 1) and row["_type"] == "T"
    assert str(row.estimated_date) == "0001-01-01"


def test_placeholders_survive_parquet(table, spark, tmp_path):
    rows = snapshot("milestones", table("milestones", dict(id=1, classifications="{}")))
    rows.write.parquet(f"{tmp_path}/m")
    assert one(spark.read.parquet(f"{tmp_path}/m")).shipped_at == datetime(1, 1, 1)


def test_provider_and_request_arrays(table):
    provider = one(
        snapshot(
            "providers",
            table(
                "providers",
                dict(id=1, uuid="u", setup=["Create Account", "x"], contact_emails=["a", "b"],
                     certifications=["c1", "c2"]),
            ),
        )
    )
    assert (provider.percent_completeness, provider.contact_emails) == (20, "a, b")
    assert provider.certifications == "c1, c2"
    request = one(snapshot("requests", table("requests", dict(id=1, filters=["a", None, "c"]))))
    assert (request.filter1, request.filter2, request.filter3) == ("a", "", "c")


def test_contract_of_plain_snapshots(table):
    for name, row in [
        ("currencies", dict(id=1)),
        ("inventory_groups", dict(id=1)),
        ("organizations", dict(id=1)),
        ("providers", dict(id=1, uuid="u", contact_emails=None)),
    ]:
        with pytest.raises(PySparkException, match=f"contract of {name}"):
            snapshot(name, table(SNAPSHOTS[name].table, row)).collect()


def test_address_lines(table):
    rows = table("addresses", dict(id=1, street="1 Main", city="Town", country="US"), dict(id=2, street=""))
    assert {r.id: r.address for r in address_lines(rows).collect()} == {1: "1 Main Town US", 2: None}
