"""Every registered query against its SQL oracle, on the smallest driver tables."""

import os

import pytest

import __spark_entry__ as contract
from checks.compare import connect, differences
from checks.oracles import ORACLES
from checks.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are absent")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, duck, name):
    problem = differences(spark, duck, FOLDER, name)
    assert not problem or problem.startswith("rows only")


# Queries whose plans hold lookups, with every lookup salted and every repeated key hot.
@pytest.mark.parametrize(
    "name", ["po_report", "order_report", "proposal_report", "events_session_email", "booster_writeback",
             "rating_report", "semi_reduced_children"],
)
def test_salted_query_equals_oracle(spark, duck, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("ledgerloom.lookup.hotRows", "2")
    try:
        assert differences(spark, duck, FOLDER, name) == ""
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
        spark.conf.unset("ledgerloom.lookup.hotRows")


def test_results_do_not_depend_on_the_session_zone(spark, duck):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for name in ("clicks_flatten", "events_month_week", "events_session_email", "month_week_calendar"):
            assert differences(spark, duck, FOLDER, name) == ""
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
