import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import calendar, jsontext, money, purchasing, text

L = F.lit


def s(value):
    return L(value).cast("string")


def strings(*items):
    return F.array(*[s(i) for i in items]).cast("array<string>")


def test_full_name(values):
    got = values(*[text.full_name(s(a), s(b)) for a, b in [(None, None), ("A", None), (None, "B"), ("A", "B")]])
    assert got == (None, "A", "B", "A B")


def test_address_line(values):
    assert values(text.address_line(s(None), s(None)), text.address_line(s(""), s(None))) == (None, None)
    assert values(text.address_line(s("1 Main"), s(None), s("Town"))) == ("1 Main Town",)


def test_positional_items(values):
    none = L(None).cast("array<string>")
    for items, expected in [
        (none, ("", "", "")),
        (strings("a"), ("a", "", "")),
        (strings("a", None, "c"), ("a", "", "c")),
    ]:
        assert values(*[text.item_or_empty(items, i) for i in range(3)]) == expected


def test_joined(values):
    none = L(None).cast("array<string>")
    assert values(text.joined(none), text.joined_or_empty(none), text.joined(strings("a", "b"))) == (
        None, "", "a, b",
    )


def test_checklist(values):
    weights = {"Create Account": 20, "Add Addresses": 20, "Bonus (x)": 7}
    cases = [
        (strings("Create Account", "x"), 20),
        (strings("Create Account", "Create Account"), 40),
        (strings("Add Addresses, Create Account"), 40),
        (strings("Create Account "), 0),
        (strings("  \tCreate Account"), 20),
        (strings("Create Accounts", "My Create Account"), 0),
        (strings("Bonus (x)", "Add Addresses"), 27),
        (F.array().cast("array<string>"), 0),
    ]
    assert values(*[text.checklist_score(c, weights) for c, _ in cases]) == tuple(n for _, n in cases)


def test_placeholders(values):
    none = L(None).cast("timestamp_ntz")
    assert values(text.or_timestamp(none, "0001-01-01 00:00:00"), text.or_date(none, "0001-01-01")) == (
        datetime(1, 1, 1), date(1, 1, 1),
    )


def test_json_members(values):
    v = jsontext.parsed(L('{"a": "x\\"y", "n": null, "o": {"k": 1}}'))
    assert values(jsontext.member_bare(v, "missing"), jsontext.member_bare(v, "n")) == ("", "null")
    assert values(jsontext.member_bare(v, "a")) == ("x\\y",)
    assert values(jsontext.member_text(v, "a"), jsontext.member_text(v, "missing")) == ('"x\\"y"', None)
    assert values(jsontext.member_quoted(v, "missing"), jsontext.member_quoted(v, "o")) == (
        "null", '{"k":1}',
    )


def test_last_of_repeated_json_members_counts(values):
    assert values(jsontext.canonical(L('{"a": 1, "a": 2}'))) == ('{"a":2}',)


def test_canonical_json(values):
    got = values(jsontext.canonical(L('{"b": [1, 2],  "a": "x"}')), jsontext.canonical(s(None)))
    assert got == ('{"a":"x","b":[1,2]}', None)


@pytest.mark.parametrize(
    "document, expected",
    [
        ('{"score": 4.5}', 4.5),
        ('{"score": [4.5, 1]}', 4.5),
        ('{"score": "4.5"}', 4.5),
        ('{"score": null}', None),
        ('{"score": []}', None),
        ('{"score": {"a": 1}}', None),
        ("{}", None),
    ],
)
def test_first_number(values, document, expected):
    assert values(jsontext.first_number(jsontext.parsed(L(document)), "score")) == (expected,)


def test_ieee_division(values):
    up, down, undefined, plain = values(
        *[money.ieee_div(L(a), L(b)) for a, b in [(10.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (9.0, 2.0)]]
    )
    assert up == math.inf and down == -math.inf and math.isnan(undefined) and plain == 4.5
    assert values(money.ieee_div(L(1.0), L(None).cast("double"))) == (None,)


def test_nonzero_fallback(values):
    none = L(None).cast("double")
    cases = [(L(0.0), L(7.0), 7.0), (L(0.0), none, 0.0), (L(5.0), L(7.0), 5.0), (none, L(3.0), 3.0)]
    assert values(*[money.nonzero_or(a, b) for a, b, _ in cases]) == tuple(c for *_, c in cases)


def test_tax_in_base(values):
    assert values(money.tax_in_base(L(10.0), L(20.0), L(5.0), L(2.0))) == (5.5,)


def test_tax_gate(values):
    start = "2018-06-01 00:00:00"
    stamps = ["2018-06-01 00:00:00", "2018-06-01 00:00:01", None]
    got = values(
        *[money.untaxed_after(L(10.0), L(2.0), s(t).cast("timestamp_ntz"), start) for t in stamps]
    )
    assert got == (10.0, 8.0, 10.0)


def status(**flags):
    base = dict(obsoleted=None, version=1, referenced=None, completed=None, rejected=None, number=None)
    base |= flags
    return purchasing.po_status(
        L(base["obsoleted"]).cast("boolean"), L(base["version"]), L(base["referenced"]).cast("int"),
        L(base["completed"]).cast("boolean"), L(base["rejected"]).cast("boolean"), s(base["number"]),
    )


def test_status_ladder(values):
    cases = [
        (status(obsoleted=True, completed=True), "Obsoleted"),
        (status(version=2, referenced=1, completed=True), "Amended"),
        (status(version=2, completed=True), "Completed"),
        (status(completed=True, rejected=True), "Completed"),
        (status(rejected=True, number="A"), "Rejected"),
        (status(), "Awaiting PO"),
        (status(number="A"), "Work in Progress"),
    ]
    assert values(*[c for c, _ in cases]) == tuple(name for _, name in cases)


def test_turn_around_units(values):
    cases = [(7199, "hours", 1), (86400, "weeks", 0), (172800, None, 2), (2592000, "months", 1)]
    assert values(*[purchasing.turn_around_units(L(a), s(u)) for a, u, _ in cases]) == tuple(
        n for *_, n in cases
    )
    assert values(purchasing.turn_around_units(L(None).cast("bigint"), s("hours"))) == (None,)


def test_epoch_and_date_text(values):
    got = values(
        calendar.from_date_text(L("/Date(1609459200123)/")),
        calendar.from_date_text(s(None)),
        calendar.from_date_text(L("yesterday")),
        calendar.from_epoch_millis(L(1609459200123)),
    )
    moment = datetime(2021, 1, 1, 0, 0, 0, 123000)
    assert got == (moment, None, None, moment)


def test_module_of_month(values):
    days = [1, 7, 8, 28, 29, 31]
    assert values(*[calendar.module(L(date(2024, 1, d))) for d in days]) == (1, 1, 2, 4, 5, 5)


def test_earlier_module_looks_at_last_but_one_day(values):
    # March 3rd looks at February 28th of a leap year: module 4, although the 29th is module 5.
    assert values(calendar.module_pair(L(date(2024, 3, 3)))) == ([4, 1],)
    assert values(calendar.module_pair(L(date(2024, 3, 8)))) == ([1, 2],)


def windows(values, day, expression=calendar.month_week_windows):
    return [(w.year, w.month, w.week) for w in values(expression(L(day)))[0]]


@pytest.mark.parametrize(
    "day, expected",
    [
        (date(2024, 6, 15), [(2024, 6, 2), (2024, 6, 3)]),
        (date(2024, 6, 3), [(2024, 5, 4), (2024, 5, 1), (2024, 6, 4), (2024, 6, 1)]),
        (date(2024, 3, 5), [(2024, 2, 5), (2024, 2, 1), (2024, 3, 5), (2024, 3, 1)]),
        (date(2023, 3, 5), [(2023, 2, 4), (2023, 2, 1), (2023, 3, 4), (2023, 3, 1)]),
        (
            date(2024, 1, 3),
            [(y, m, w) for y in (2023, 2024) for m in (12, 1) for w in (4, 1)],
        ),
    ],
)
def test_refresh_windows(values, day, expected):
    assert windows(values, day) == expected


def test_contiguous_windows(values):
    assert windows(values, date(2024, 6, 3), calendar.contiguous_windows) == [
        (2024, 5, 5), (2024, 6, 1),
    ]


def test_refresh_windows_never_overlap(spark):
    days = spark.sql("select explode(sequence(date'2023-01-01', date'2025-01-01')) as day")
    rows = days.select("day", F.explode(calendar.month_week_windows(F.col("day"))).alias("w"))
    rows = rows.select("day", "w.*")
    assert rows.where("last_day < first_day").count() == 0
    a, b = rows.alias("a"), rows.alias("b")
    overlap = a.join(b, (F.col("a.day") == F.col("b.day")) & (F.col("a.first_day") < F.col("b.first_day")))
    assert overlap.where("a.last_day >= b.first_day").count() == 0


def test_trailing_weeks(values):
    (mondays,) = values(calendar.trailing_weeks(L(date(2024, 1, 30))))
    assert mondays[0] == date(2023, 12, 18) and mondays[-1] == date(2024, 1, 29)
    for offset in range(7):
        day = date(2024, 5, 6 + offset)
        (mondays,) = values(calendar.trailing_weeks(L(day)))
        # Seven weeks when the day 37 days earlier is a Saturday or Sunday.
        back = date.fromordinal(day.toordinal() - 37).weekday()
        assert len(mondays) == (7 if back >= 5 else 6)


@pytest.mark.parametrize(
    "token, shown",
    [("1.0", "1.0"), ("1.50", "1.5"), ("1e2", "100.0"), ("-7", "-7"), ("1e22", "1e22"), ("0.1", "0.1"), ('"1.0"', '"1.0"'), ("[1, 2]", "[1,2]"), ("true", "true"), ("null", "null")],
)
def test_numbers_of_members_keep_their_kind(values, token, shown):
    source = L('{"b": 1, "it\'s a": %s}' % token)
    v = jsontext.parsed(source)
    got = values(jsontext.member_text(v, "a", source), jsontext.member_quoted(v, "c", source), jsontext.member_bare(v, "c", source))
    assert got == (None, "null", "")
    source = L('{"b": 1, "a": %s}' % token)
    v = jsontext.parsed(source)
    assert values(jsontext.member_text(v, "a", source), jsontext.member_quoted(v, "a", source)) == (shown, shown)
    assert values(jsontext.member_bare(v, "a", source)) == (shown.replace('"', ""),)
