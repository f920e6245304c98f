"""Benchmark: seconds per registered headline query, one JSON line on stdout.

Reads BENCH_SF_DIR (default /root/testdata/sf0.1) on local[BENCH_CPUS]. Every query is computed in
full into the noop sink; the figure is the median of the timed runs after one warm-up run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from checks.queries import QUERIES
from ledgerloom.session import local_session

HEADLINE = (
    "po_report", "po_retail_totals", "contract_rejects", "proposal_report", "order_report",
    "order_timepoint_pivot", "invoice_report", "rating_report", "milestone_placeholders",
    "refs_json_fields", "refs_provider_score", "events_month_week", "events_month_week_windowed",
    "events_session_email", "events_iso_week_counts", "forms_windowed", "clicks_flatten",
    "clicks_dedupe", "clicks_new_only", "booster_writeback", "semi_reduced_children", "first_wins",
    "refresh_windows", "snapshot_notes",
)


def seconds(spark, folder: str, name: str, runs: int) -> float:
    times = []
    for _ in range(runs + 1):
        started = time.monotonic()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times.append(time.monotonic() - started)
    return round(statistics.median(times[1:]), 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, memory=os.environ.get("BENCH_MEMORY", "16g"))
    results = {name: seconds(spark, folder, name, runs) for name in names}
    line = {
        "metric": "total_query_seconds",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
