"""Run every registered query and its oracle side by side: `python -m checks.compare [sf] [names]`.

COMPARE_CONF may hold session settings (`key=value`, space separated), for instance to switch
broadcasts off or to change the time zone.
"""

from __future__ import annotations

import math
import os
import sys
import time
from datetime import date, datetime
from decimal import Decimal

import duckdb

from ledgerloom.session import local_session

from .entities import BASE_TABLES
from .oracles import ORACLES
from .queries import QUERIES


def plain(value):
    """A comparable form of a cell, exact for everything but the type of numbers."""
    if value is None:
        return "~"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0) if value != int(value or 0) or math.isinf(value) else str(int(value))
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def connect(folder: str):
    connection = duckdb.connect()
    for table in BASE_TABLES:
        connection.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    return connection


def differences(spark, connection, folder: str, name: str) -> str:
    """'' when query and oracle agree, else what differs."""
    frame = QUERIES[name](spark, folder)
    got = rows_of(frame.columns, frame.collect())
    if name not in ORACLES:
        return f"rows only: {len(got)}"
    result = connection.sql(ORACLES[name])
    columns = list(result.columns)
    want = rows_of(columns, result.fetchall())
    if sorted(frame.columns) != sorted(columns):
        return f"columns {sorted(set(frame.columns) ^ set(columns))}"
    if got == want:
        return ""
    ours, theirs = set(got) - set(want), set(want) - set(got)
    sample = [sorted(x)[:1] for x in (ours, theirs)]
    cells = []
    if sample[0] and sample[1]:
        cells = [
            (c, a, b) for c, a, b in zip(sorted(columns), sample[0][0], sample[1][0]) if a != b
        ]
    return f"{len(got)} vs {len(want)} rows, {len(ours)}/{len(theirs)} differ: {cells or sample}"


def main() -> None:
    scale = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:] or list(QUERIES)
    folder = f"/root/testdata/sf{scale}"
    spark, connection = local_session(8), connect(folder)
    for setting in os.environ.get("COMPARE_CONF", "").split():
        spark.conf.set(*setting.split("=", 1))
    failed = 0
    for name in names:
        started = time.monotonic()
        try:
            problem = differences(spark, connection, folder, name)
        except Exception as error:  # report and go on with the next query
            problem = f"error {str(error)[:600]}"
        failed += bool(problem) and not problem.startswith("rows only")
        print(f"{name:32s} {time.monotonic() - started:6.2f}s {problem or 'equal'}", flush=True)
    print(f"{failed} of {len(names)} differ")


if __name__ == "__main__":
    main()
