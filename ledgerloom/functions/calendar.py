"""Calendar expressions: month-week modules, ISO weeks, epoch conversions and refresh windows.

A "module" is a week of the month: days 1-7, 8-14, 15-21, 22-28 and the rest.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WINDOW_TYPE = "struct<year:int,month:int,week:int,first_day:date,last_day:date>"


def next_day(day: Column) -> Column:
    return F.date_add(day, 1)


def previous_day(day: Column) -> Column:
    return F.date_sub(day, 1)


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def month_end(day: Column) -> Column:
    return F.last_day(day)


def next_month_start(day: Column) -> Column:
    return F.date_add(F.last_day(day), 1)


def previous_month_end(day: Column) -> Column:
    return F.date_sub(F.trunc(day, "MM"), 1)


def module(day: Column) -> Column:
    """Week of month, 1 to 5."""
    return F.ceil(F.dayofmonth(day) / 7).cast("int")


def is_leap(year: Column) -> Column:
    return F.dayofmonth(F.last_day(F.make_date(year, F.lit(2), F.lit(1)))) == 29


def earlier_module(day: Column) -> Column:
    """Module a week earlier; in the first week it looks at the last but one day of the month before."""
    dom = F.dayofmonth(day)
    return module(F.date_sub(day, F.when(dom > 7, F.lit(7)).otherwise(dom + 1)))


def module_pair(day: Column) -> Column:
    return F.array(earlier_module(day), module(day))


def module_first_day(year: Column, month: Column, week: Column) -> Column:
    return F.make_date(year, month, (week - 1) * 7 + 1)


def module_last_day(year: Column, month: Column, week: Column) -> Column:
    length = F.dayofmonth(F.last_day(F.make_date(year, month, F.lit(1))))
    return F.make_date(year, month, F.least(week * 7, length))


def week_start(day: Column) -> Column:
    """Monday of the ISO week."""
    return F.trunc(F.to_date(day), "week")


def month_week_label(stamp: Column) -> Column:
    """Partition value 'year-month-week', without padding."""
    day = F.to_date(stamp)
    return F.concat_ws(
        "-", F.year(day).cast("string"), F.month(day).cast("string"), module(day).cast("string")
    )


def from_epoch_millis(millis: Column) -> Column:
    """Epoch milliseconds to a zone-free UTC timestamp, millis kept."""
    seconds = millis.cast("decimal(18,3)") / F.lit(1000)
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def from_date_text(text: Column) -> Column:
    """'/Date(ms)/' text to a timestamp; null when the pattern is absent."""
    digits = F.regexp_extract(text, r"Date\(([0-9]+)", 1)
    return from_epoch_millis(F.nullif(digits, F.lit("")).cast("bigint"))


def _window(year: Column, month: Column, week: Column) -> Column:
    return F.struct(
        year.alias("year"),
        month.alias("month"),
        week.alias("week"),
        module_first_day(year, month, week).alias("first_day"),
        module_last_day(year, month, week).alias("last_day"),
    )


def month_week_windows(today: Column) -> Column:
    """Modules to rebuild on a given day, as an array of windows.

    The usual set is the current and the previous module. In the first module of a month it is
    {previous, current month} x {week 4, week 1}, with week 5 instead of 4 after a leap February; in
    the first days of January also {previous, current year} x {12, 1}.
    """
    year, month, week = F.year(today), F.month(today), module(today)
    new_year = (month == 1) & (week == 1)
    years = F.when(new_year, F.array(year - 1, year)).otherwise(F.array(year))
    months = (
        F.when(new_year, F.array(F.lit(12), month))
        .when(week == 1, F.array(month - 1, month))
        .otherwise(F.array(month))
    )
    leap_march = (month == 3) & is_leap(year)
    weeks = F.when(
        week == 1, F.array(F.when(leap_march, F.lit(5)).otherwise(F.lit(4)), F.lit(1))
    ).otherwise(F.array(week - 1, week))
    grid = F.flatten(
        F.transform(
            years,
            lambda y: F.flatten(
                F.transform(
                    months,
                    lambda m: F.transform(
                        weeks,
                        lambda w: F.struct(y.alias("y"), m.alias("m"), w.alias("w")),
                    ),
                )
            ),
        )
    )
    exists = F.filter(
        grid, lambda g: ~((g["m"] == 2) & (g["w"] == 5) & ~is_leap(g["y"]))
    )
    return F.transform(exists, lambda g: _window(g["y"], g["m"], g["w"]))


def contiguous_windows(today: Column) -> Column:
    """The module before the current one in time, then the current one."""
    first = module_first_day(F.year(today), F.month(today), module(today))
    return F.transform(
        F.array(F.date_sub(first, 1), today),
        lambda d: _window(F.year(d), F.month(d), module(d)),
    )


def trailing_weeks(today: Column, days_back: int = 37) -> Column:
    """Mondays from the week of (today - days_back) through the week of today."""
    start = F.trunc(F.date_sub(today, days_back), "week")
    return F.sequence(start, today, F.expr("interval 7 days"))
