"""Searches of segments take steps by run, not by window."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ledgerloom.llm import substrings


@pytest.mark.parametrize("copies", [1, 2])
def test_a_repeated_run_of_windows_is_searched_once(monkeypatch, copies):
    r = random.Random(4)
    window, lanes = 10, []
    plain = substrings.FMIndex.step
    monkeypatch.setattr(substrings.FMIndex, "step", lambda self, symbol, places: lanes.append(len(symbol)) or plain(self, symbol, places))
    long_runs = [np.array([r.randrange(1 << 40) for _ in range(window + 19)], np.uint64) for _ in range(30)]
    edited = [np.concatenate([p[:14], p[15:]]) for p in long_runs[:10]]
    mixed = [np.array([r.randrange(3) for _ in range(window + r.randrange(6))], np.uint64) for _ in range(30)]
    parts = long_runs + edited + mixed
    weights = [copies] * 30 + [1] * 40
    table = pa.table({"minimiser": [7] * len(parts), "segment": list(range(len(parts))), "weight": weights, "words": [substrings._packed(p) for p in parts]})
    counts = Counter()
    for p, w in zip(parts, weights, strict=True):
        for k in range(len(p) - window + 1):
            counts[tuple(p[k : k + window])] += w
    want = {i: sum(1 << k for k in range(len(p) - window + 1) if counts[tuple(p[k : k + window])] > 1) for i, p in enumerate(parts)}
    found = substrings._search_shard(table, window).to_pylist()
    assert {x["segment"]: x["mask"] for x in found} == {i: m for i, m in want.items() if m}
    if copies == 2:
        # 30 runs of 20 windows each: a search of every window takes 30 * 20 * 10 steps for them alone.
        assert sum(lanes) < 5_000


def test_runs_of_a_mask():
    r = random.Random(9)
    for mask in [0, 1, 2, (1 << 63) - 1, 1 << 62, *(r.getrandbits(63) for _ in range(200))]:
        bits = [k for k in range(63) if mask >> k & 1]
        runs = substrings.runs_of(mask)
        assert [k for a, b in runs for k in range(a, b)] == bits
        assert all(b < c for (_, b), (c, _) in zip(runs, runs[1:], strict=False))
