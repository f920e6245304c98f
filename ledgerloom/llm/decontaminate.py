"""Benchmark decontamination with one Aho-Corasick automaton.

Benchmark texts and documents are normalised alike (A-Z lower-cased, every run of ASCII characters that
are neither letters nor digits becomes one space). A pattern is a window of `WINDOW` consecutive words
of an item; words are numbered, so it matches whole words only. Each text is scanned once; places are
word numbers and, through those, character offsets of the original.

The automaton travels with the tasks. It is made of at most about `PART_BYTES` of benchmark text, which
is 15 nodes a word at most, some 200 MB. Longer items are cut into pieces that share `WINDOW` - 1 words,
and a larger benchmark is split into parts of that size, one scan each; the hit intervals of a
document are merged by its row.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import alnum_words, checkpointed, map_texts

WINDOW = 13
PART_BYTES = 1 << 20
# A document is contaminated if at least one in RATIO of its words is hit.
RATIO = 20
# Words of the original text, with either case of A-Z.
WORD = re.compile(r"[0-9A-Za-z\x80-\U0010FFFF]+")


def item_windows(text: str | None, window: int = WINDOW) -> set[tuple[bytes, ...]]:
    """Windows of normalised words of an item; a shorter item is one window, one without words has none."""
    words = alnum_words(text)
    if not words:
        return set()
    last = max(1, len(words) - window + 1)
    return {tuple(words[i : i + window]) for i in range(last)}


class Machine:
    """One Aho-Corasick automaton over word numbers: a node per word of a window, `window` at most for each."""

    def __init__(self, items: Iterable[tuple[object, str | None]], window: int = WINDOW) -> None:
        self.numbers: dict[bytes, int] = {}
        self.made = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        owners: dict[tuple[int, ...], set] = {}
        for item, text in items:
            for pattern in item_windows(text, window):
                # Number 0 is any word that no item has.
                key = tuple(self.numbers.setdefault(w, len(self.numbers) + 1) for w in pattern)
                owners.setdefault(key, set()).add(item)
        for key, ids in owners.items():
            self.made.add_word(key, (len(key), tuple(ids)))
        if owners:
            self.made.make_automaton()
        self.empty = not owners

    def found(self, words: list[bytes]) -> list[tuple[int, int, tuple]]:
        """(first word, number of words, ids of the items) of every place of a window, by its first word."""
        known = self.numbers.get
        numbers = tuple([known(w, 0) for w in words])
        if self.empty or not any(numbers):
            return []
        return sorted(((end - n + 1, n, ids) for end, (n, ids) in self.made.iter(numbers)), key=lambda x: x[0])


def automaton(items: Iterable[tuple[object, str | None]], window: int = WINDOW) -> Machine:
    """All windows of the (id, text) items; a window knows its words and the ids of the items that have it."""
    return Machine(items, window)


def scan(machine: Machine, text: str | None) -> tuple[int, list[tuple[int, int]], set]:
    """(words of the text, merged hit word intervals [from, to), items that occur)."""
    words = alnum_words(text)
    items: set = set()
    spans: list[tuple[int, int]] = []
    for start, n, ids in machine.found(words):
        items.update(ids)
        if spans and start <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(spans[-1][1], start + n))
        else:
            spans.append((start, start + n))
    return len(words), spans, items


def original_spans(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Character offsets [from, to) in the original text of word intervals."""
    places = [m.span() for m in WORD.finditer(text)]
    return [(places[a][0], places[b - 1][1]) for a, b in spans]


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, part_bytes: int = PART_BYTES) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, item_ids (sorted as strings), spans (original characters), contaminated.

    Null and empty texts have no words and are clean; an empty benchmark hits nothing; an item
    without id or words takes no part; documents that repeat a doc_id are judged row by row. Whole texts
    are scanned, however long; a repeated item counts once by its id; an empty table gives no rows; only
    doc_id and text are read, so other columns cannot clash.
    """
    items = _items(benchmark, window, part_bytes)
    parts = _parts(items, part_bytes)
    if parts == 1:
        return _scan_part(docs, items, window, ["doc_id"])
    # Beyond the bound: one scan per part; a row number per document ties its parts together.
    numbered = checkpointed(docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row_no")))
    found = None
    for part in range(parts):
        own = items.where(F.pmod(F.xxhash64("item_id", "piece"), F.lit(parts)) == part)
        one = _scan_part(numbered, own, window, ["doc_id", "row_no"])
        found = one if found is None else found.unionByName(one)
    merged = found.groupBy("row_no").agg(
        F.first("doc_id").alias("doc_id"),
        F.max("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("words"))).alias("words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
    )
    # Intervals are in order of their start: each adds what lies behind the furthest end so far.
    seen = F.aggregate(
        "words",
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda s, x: F.struct(
            F.greatest(s["end"], x["stop"]).alias("end"),
            (s["n"] + F.greatest(F.lit(0), x["stop"] - F.greatest(s["end"], x["start"]))).alias("n"),
        ),
        lambda s: s["n"],
    )
    counted = merged.withColumn("n_hit", seen)
    bad = (F.col("n_hit") > 0) & (RATIO * F.col("n_hit") >= F.col("n_words"))
    return counted.select("doc_id", "n_words", "n_hit", "item_ids", "spans", "words", bad.alias("contaminated"))


def _items(benchmark: DataFrame, window: int, part_bytes: int) -> DataFrame:
    """(item_id, piece, text): items with pieces of at most a quarter of `part_bytes`, and the words two pieces share."""
    most = max(1, part_bytes // 4)

    def work(rows: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {"item_id": [], "piece": [], "text": []}
        for item, text in zip(rows["item_id"], rows["text"], strict=True):
            for k, piece in enumerate(pieces(text, window, most)):
                for name, value in (("item_id", item), ("piece", k), ("text", piece)):
                    out[name].append(value)
        return out

    given = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("string").alias("item_id"), "text")
    return map_texts(given, ["item_id", "text"], "text", "item_id string, piece int, text string", work)


def pieces(text: str, window: int, most: int) -> list[str]:
    """A text of over `most` bytes cut between words; pieces share window - 1 words, so no window is lost or new."""
    if len(text.encode("utf-8", "surrogatepass")) <= most:
        return [text]
    words = [w.decode("utf-8", "surrogatepass") for w in alnum_words(text)]
    out, start, end = [], 0, 0
    while end < len(words):
        end, size = start, 0
        while end < len(words) and (end - start < window or size <= most):
            size += len(words[end].encode("utf-8", "surrogatepass")) + 1
            end += 1
        out.append(" ".join(words[start:end]))
        start = end - window + 1
    return out


def _parts(items: DataFrame, part_bytes: int) -> int:
    return 1 + (items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // part_bytes


def _scan_part(docs: DataFrame, items: DataFrame, window: int, keys: list[str]) -> DataFrame:
    patterns = [(r.item_id, r.text) for r in items.toLocalIterator()]

    def setup() -> Callable[[dict[str, list]], dict[str, list]]:
        machine = automaton(patterns, window)

        def work(rows: dict[str, list]) -> dict[str, list]:
            out: dict[str, list] = {k: rows[k] for k in keys}
            fresh = {k: [] for k in ("n_words", "n_hit", "item_ids", "spans", "words", "contaminated")}
            for text in rows["text"]:
                n, spans, ids = scan(machine, text)
                hit = sum(b - a for a, b in spans)
                fresh["n_words"].append(n)
                fresh["n_hit"].append(hit)
                fresh["item_ids"].append(sorted(ids))
                fresh["spans"].append([{"start": a, "stop": b} for a, b in original_spans(text, spans)] if spans else [])
                fresh["words"].append([{"start": a, "stop": b} for a, b in spans])
                fresh["contaminated"].append(hit > 0 and RATIO * hit >= n)
            return out | fresh

        return work

    interval = "array<struct<start: int, stop: int>>"
    schema = ", ".join(f"{k} long" for k in keys) + (
        f", n_words long, n_hit long, item_ids array<string>, spans {interval}, words {interval}, contaminated boolean"
    )
    return map_texts(docs, [*keys, "text"], "text", schema, work=dict, setup=setup)


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, part_bytes: int = PART_BYTES) -> DataFrame:
    """`docs` without the contaminated rows, each judged by its own text; nulls and empty texts stay.

    With a benchmark within the bound this is one pass without a shuffle; beyond it, rows are numbered
    and judged through `hits`.
    """
    items = _items(benchmark, window, part_bytes)
    if _parts(items, part_bytes) > 1:
        numbered = checkpointed(docs.withColumn("__row", F.monotonically_increasing_id()))
        judged = hits(numbered.select(F.col("__row").alias("doc_id"), "text"), benchmark, window, part_bytes)
        bad = judged.where("contaminated").select(F.col("doc_id").alias("__row"))
        return numbered.join(bad, "__row", "left_anti").drop("__row")
    patterns = [(r.item_id, r.text) for r in items.toLocalIterator()]

    @F.pandas_udf("boolean")
    def contaminated(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        machine = automaton(patterns, window)
        for part in parts:
            found = []
            for text in part:
                n, spans, _ = scan(machine, text)
                hit = sum(b - a for a, b in spans)
                found.append(hit > 0 and RATIO * hit >= n)
            yield pd.Series(found, dtype=bool)

    return docs.where(~contaminated("text"))
