"""Substring de-duplication with compressed FM-indexes.

Every window of `WINDOW` words has a minimiser: the `GRAM`-word gram of smallest hash inside it (the
leftmost of equals), which depends on the window's words only. Consecutive windows with one minimiser
form a segment; each window of the corpus lies in exactly one segment, and equal windows in segments of
one minimiser. Minimisers that occur once need no search. The distinct segments of the others, with the
number of their occurrences as weight, are dealt to shards by minimiser. Each shard builds a compressed
FM-index (wavelet matrix over packed bits with block counts) and streams its segments through it: a
backward search from a segment's end gives the matching statistic, and a window inside it has a weight
of two or more; only the windows before it are searched again, in halves. A minimiser with more than `HOT` distinct
segments would make its shard too large: a passage that many documents share among different words has
as many segments. Its windows are grouped by their words in Spark instead, with weights summed before
the shuffle, so no task depends on the frequency of one passage. Words are compared as 48-bit hashes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import checkpointed, map_texts

WINDOW, GRAM = 35, 8
HOT, SHARD_SEGMENTS = 20_000, 8_000
HASH_BITS = 48
LOW32 = np.uint64(0xFFFFFFFF)
BASE, BASE_2 = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
LANES = 100_000


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, unchanged."""
    return text.encode("utf-8", "surrogatepass").split() if text is not None else []


def hashes(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(w) for w in words), np.uint64, len(words)) >> np.uint64(64 - HASH_BITS)


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every `width` consecutive values."""
    out, span = values, 1
    while span < width:
        step = min(span, width - span)
        out = np.minimum(out[: len(out) - step], out[step:])
        span += step
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _runs_hash(words: np.ndarray, width: int, base: int = BASE) -> np.ndarray:
    """A 64-bit hash of every `width` consecutive word hashes."""
    acc = np.zeros(len(words) - width + 1, np.uint64)
    for i in range(width):
        acc = acc * np.uint64(base) + words[i : i + len(acc)]
    return _mixed(acc)


def segments(words: np.ndarray, sizes: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Segments of texts whose word hashes stand one after the other, `sizes` words each.

    (minimiser hash, hash of the segment's words, text number, first window in the text, number of windows).
    """
    if len(words) < window:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
    begin = np.cumsum(sizes) - sizes
    text = np.repeat(np.arange(len(sizes)), sizes)
    grams = _runs_hash(words, gram)
    lowest = _sliding_min((grams & ~LOW32) | np.arange(len(grams), dtype=np.uint64), window - gram + 1)
    at = (lowest & LOW32).astype(np.int64)
    # A window that runs into the next text is none.
    inside = text[: len(at)] == text[window - 1 :]
    at[~inside] = -1
    edges = np.flatnonzero(np.append(True, (at[1:] != at[:-1]) | (text[1 : len(at)] != text[: len(at) - 1])))
    n = np.diff(np.append(edges, len(at)))
    real = at[edges] >= 0
    first, n = edges[real], n[real]
    # Sums of word * B^place, shifted back to place 0 by the inverse of B modulo 2^64.
    base = np.full(len(words), BASE, np.uint64)
    base[0] = 1
    power = np.multiply.accumulate(base)
    back = np.full(len(words), pow(BASE, -1, 1 << 64), np.uint64)
    back[0] = 1
    shift = np.multiply.accumulate(back)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((words + np.uint64(1)) * power)])
    whole = (sums[first + n + window - 1] - sums[first]) * shift[first] + (n.astype(np.uint64) << np.uint64(48))
    owner = text[first]
    return grams[at[first]], _mixed(whole), owner, first - begin[owner], n


class FMIndex:
    """FM-index of segments (arrays of symbols) with weights; patterns may be up to `depth` symbols long.

    Suffixes are sorted by their first `depth` symbols, which is all that intervals of such patterns
    depend on. The transform is kept as a wavelet matrix: one packed bit row per level, with the number
    of ones before each 64-bit word.
    """

    def __init__(self, parts: list[np.ndarray], weights: np.ndarray, depth: int) -> None:
        sizes = np.array([len(p) + 1 for p in parts])
        joined = np.zeros(int(sizes.sum()), np.uint64)
        self.starts = np.cumsum(sizes) - sizes
        inside = np.ones(len(joined), bool)
        inside[self.starts + sizes - 1] = False
        joined[inside] = np.concatenate(parts)
        self.alphabet, symbol = np.unique(joined[inside], return_inverse=True)
        self.text = np.zeros(len(joined), np.int64)
        self.text[inside] = symbol + 1
        order = self._suffixes(depth)
        before = self.text[order - 1]
        owner = np.repeat(np.arange(len(parts)), sizes)
        self.weight = np.concatenate([[0], np.cumsum(weights[owner[order]])])
        self.first = np.concatenate([[0], np.cumsum(np.bincount(self.text, minlength=len(self.alphabet) + 1))])
        self.levels: list[tuple[np.ndarray, np.ndarray, int]] = []
        current = before
        for bit in reversed(range(max(1, int(len(self.alphabet)).bit_length()))):
            ones = (current >> bit & 1).astype(bool)
            packed = np.packbits(ones, bitorder="little")
            packed = np.concatenate([packed, np.zeros(-len(packed) % 8 + 8, np.uint8)]).view(np.uint64)
            counts = np.concatenate([[0], np.cumsum(np.bitwise_count(packed))[:-1]]).astype(np.int32)
            self.levels.append((packed, counts, int(len(ones) - ones.sum())))
            current = np.concatenate([current[~ones], current[ones]])
        # A symbol's occurrences stand together behind the last level; from there to its suffixes is one shift.
        symbols = np.arange(len(self.alphabet) + 1)
        self.shift = np.zeros(len(symbols), np.int64)
        bottom = self.step(symbols, np.zeros((2, len(symbols)), np.int64))[0]
        self.shift = self.first[:-1] - bottom

    def _suffixes(self, depth: int) -> np.ndarray:
        n, rank, span = len(self.text), self.text.copy(), 1
        order = np.argsort(rank)
        while span < depth:
            ahead = np.zeros(n, np.int64)
            ahead[: n - span] = rank[span:] + 1
            key = rank * (n + 2) + ahead
            order = np.argsort(key)
            moved = key[order]
            new = np.empty(n, np.int64)
            new[order] = np.cumsum(np.append(False, moved[1:] != moved[:-1]))
            rank, span = new, span * 2
            if rank.max() == n - 1:
                break
        return order

    def step(self, symbol: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Backward step: where suffixes that put `symbol` before those up to each place begin; places are (2, lanes)."""
        top = len(self.levels) - 1
        for k, (packed, counts, zeros) in enumerate(self.levels):
            word = places >> 6
            below = packed[word] & ((np.uint64(1) << (places & 63).view(np.uint64)) - np.uint64(1))
            ones = counts[word] + np.bitwise_count(below)
            places = np.where((symbol >> (top - k) & 1).astype(bool), zeros + ones, places - ones)
        return places + self.shift[symbol]

    def statistics(self, ends: np.ndarray, limits: np.ndarray) -> np.ndarray:
        """Matching statistic of each text place: how many symbols before it, `limits` at most, have a weight of two or more.

        Backward search over all places together; a place leaves once its statistic is settled.
        """
        reached = limits.astype(np.int64)
        lane = np.flatnonzero(limits > 0)
        low, high, at, left = np.zeros(len(lane), np.int64), np.full(len(lane), len(self.text)), ends[lane], limits[lane]
        depth = 0
        while len(lane):
            at = at - 1
            symbol = self.text[at]
            low, high = self.step(symbol, np.stack([low, high]))
            alive = self.weight[high] - self.weight[low] >= 2
            reached[lane[~alive]] = depth
            depth += 1
            alive &= left > depth
            if not alive.all():
                lane, low, high, at, left = lane[alive], low[alive], high[alive], at[alive], left[alive]
        return reached

    def repeated(self, ends: np.ndarray, length: int) -> np.ndarray:
        """Whether the `length` symbols before each text place `ends` have a weight of two or more."""
        return self.statistics(ends, np.full(len(ends), length)) == length

    def repeated_starts(self, starts: np.ndarray, n: np.ndarray, length: int) -> np.ndarray:
        """Per text place, whether a string of `length` symbols that starts there has a weight of two or more.

        Asked of `n` places from each of `starts`. One search from the last string's end settles every string
        that lies inside its matching statistic, so a run that is repeated as a whole is searched
        once. What is left of a run is halved, and each half searched again.
        """
        change = np.zeros(len(self.text) + 1, np.int64)
        first, last = starts.astype(np.int64), starts + n - 1
        while len(first):
            ends = last + length
            reached = np.concatenate([self.statistics(ends[i : i + LANES], (ends - first)[i : i + LANES]) for i in range(0, len(ends), LANES)])
            begin = ends - reached
            found = reached >= length
            change[begin[found]] += 1
            change[last[found] + 1] -= 1
            last = np.where(found, begin, last) - 1
            open_ = last >= first
            first, last = first[open_], last[open_]
            middle = (first + last) >> 1
            more = last > middle
            first, last = np.concatenate([first, middle[more] + 1]), np.concatenate([middle, last[more]])
        return np.cumsum(change[:-1]) > 0


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and a row key. Equal rows share a key: what holds for one holds for the other."""
    return docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("key"))


def occurrences(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(minimiser, segment, key, first, n) of all segments of `keyed` documents; no shuffle."""

    def work(rows: dict[str, list]) -> dict[str, np.ndarray]:
        texts = [words_of(t) for t in rows["text"]]
        codes = hashes([w for words in texts for w in words])
        minimiser, segment, owner, first, n = segments(codes, np.array([len(w) for w in texts], np.int64), window)
        key = np.array(rows["key"], np.int64)[owner]
        return {"minimiser": minimiser.view(np.int64), "segment": segment.view(np.int64), "key": key, "first": first, "n": n}

    return map_texts(docs.where("text is not null"), ["key", "text"], "text", "minimiser long, segment long, key long, first int, n int", work)


def _packed(codes: np.ndarray) -> bytes:
    return np.ascontiguousarray(codes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : HASH_BITS // 8]).tobytes()


def _unpacked(value: bytes) -> np.ndarray:
    wide = np.zeros((len(value) // (HASH_BITS // 8), 8), np.uint8)
    wide[:, : HASH_BITS // 8] = np.frombuffer(value, np.uint8).reshape(-1, HASH_BITS // 8)
    return wide.view("<u8").ravel().astype(np.uint64)


def _marked(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """(text, marks): each text that holds the place of a chosen segment, with its segments."""
    lists = chosen.groupBy("key").agg(F.collect_list(F.struct("first", "n", "minimiser", "segment", "weight")).alias("marks"))
    return docs.where("text is not null").join(lists, "key").select("text", "marks")


def _routed(docs: DataFrame, chosen: DataFrame, shards: int, window: int) -> DataFrame:
    """The words of chosen segments, each with its shard."""

    def work(rows: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {k: [] for k in ("shard", "minimiser", "segment", "weight", "words")}
        for text, marks in zip(rows["text"], rows["marks"], strict=True):
            codes = hashes(words_of(text))
            for m in marks:
                own = codes[m["first"] : m["first"] + m["n"] + window - 1]
                for name, value in (("shard", m["minimiser"] % shards), ("minimiser", m["minimiser"]), ("segment", m["segment"]), ("weight", m["weight"]), ("words", _packed(own))):
                    out[name].append(value)
        return out

    return map_texts(_marked(docs, chosen), ["text", "marks"], "text", "shard int, minimiser long, segment long, weight long, words binary", work)


def _hot_windows(docs: DataFrame, chosen: DataFrame, window: int) -> DataFrame:
    """(minimiser, segment, mask) of the windows of chosen segments that occur twice, a row for each; a mask has one bit.

    Equal windows are merged by two 64-bit hashes of their words; a segment that was delivered twice counts once.
    """

    def work(rows: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {k: [] for k in ("minimiser", "segment", "part", "weight", "w1", "w2")}
        for text, marks in zip(rows["text"], rows["marks"], strict=True):
            codes = hashes(words_of(text))
            for m in marks:
                n, own = m["n"], codes[m["first"] : m["first"] + m["n"] + window - 1]
                for name in ("minimiser", "segment", "weight"):
                    out[name] += [m[name]] * n
                out["part"] += range(n)
                out["w1"] += _runs_hash(own, window).view(np.int64).tolist()
                out["w2"] += _runs_hash(own, window, BASE_2).view(np.int64).tolist()
        return out

    schema = "minimiser long, segment long, part int, weight long, w1 long, w2 long"
    parts = checkpointed(map_texts(_marked(docs, chosen), ["text", "marks"], "text", schema, work).distinct())
    twice = parts.groupBy("w1", "w2").agg(F.sum("weight").alias("total")).where("total > 1").select("w1", "w2")
    # Cut off from its aggregate, the join may split a window that very many segments have.
    found = parts.join(checkpointed(twice), ["w1", "w2"])
    return found.select("minimiser", "segment", F.expr("shiftleft(1L, part)").alias("mask"))


def _search_shard(table: pa.Table, window: int) -> pa.Table:
    """Masks of repeated windows of a shard's segments; a segment that was delivered twice counts once."""
    columns = {n: table.column(n).to_pylist() for n in ("minimiser", "segment", "weight", "words")}
    at = {key: i for i, key in enumerate(zip(columns["minimiser"], columns["segment"], strict=True))}
    keys, rows = list(at), list(at.values())
    parts = [_unpacked(columns["words"][i]) for i in rows]
    weights = np.array([columns["weight"][i] for i in rows], np.int64)
    # Patterns may be as long as a segment.
    index = FMIndex(parts, weights, max(map(len, parts)))
    n = np.array([len(p) - window + 1 for p in parts])
    offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    found = index.repeated_starts(index.starts, n, window)[np.repeat(index.starts, n) + offset]
    masks = np.add.reduceat(np.where(found, 1 << offset, 0), np.cumsum(n) - n)
    kept = [(m, s, int(x)) for (m, s), x in zip(keys, masks, strict=True) if x]
    return pa.table({"minimiser": pa.array([k[0] for k in kept], pa.int64()), "segment": pa.array([k[1] for k in kept], pa.int64()), "mask": pa.array([k[2] for k in kept], pa.int64())})


def repeated_windows(docs: DataFrame, window: int = WINDOW, hot: int = HOT, shard_segments: int = SHARD_SEGMENTS) -> DataFrame:
    """(key, first, mask) for `keyed` documents: bit k of mask is set if window first + k starts elsewhere too."""
    every = occurrences(docs, window)
    shared = every.groupBy("minimiser").agg(F.count("*").alias("total")).where("total > 1").select("minimiser")
    # Cut off from its aggregate, the join may split a minimiser that very many segments have.
    open_rows = checkpointed(every.join(checkpointed(shared), "minimiser"))
    distinct = open_rows.groupBy("minimiser", "segment").agg(F.count("*").alias("weight"), F.min(F.struct("key", "first", "n")).alias("place"))
    distinct = checkpointed(distinct.select("minimiser", "segment", "weight", "place.key", "place.first", "place.n"))
    many = checkpointed(distinct.groupBy("minimiser").agg(F.count("*").alias("parts")).where(F.col("parts") > hot).select("minimiser"))
    chosen = distinct.join(many, "minimiser", "left_anti")
    routed = _routed(docs, chosen, 1 + chosen.count() // shard_segments, window)

    def search(part: pa.Table) -> pa.Table:
        return _search_shard(part, window)

    masks = routed.groupBy("shard").applyInArrow(search, "minimiser long, segment long, mask long")
    if not many.isEmpty():
        masks = masks.unionByName(_hot_windows(docs, distinct.join(many, "minimiser"), window))
    # Cut off from its aggregate, the join may split a segment that very many documents share.
    masks = checkpointed(masks.groupBy("minimiser", "segment").agg(F.bit_or("mask").alias("mask")))
    return open_rows.join(masks, ["minimiser", "segment"]).select("key", "first", "mask")


def runs_of(mask: int) -> list[tuple[int, int]]:
    """Runs of the set bits of a mask: (from, to), the end left out."""
    runs, at = [], 0
    while mask:
        zeros = (mask & -mask).bit_length() - 1
        mask >>= zeros
        ones = (~mask & (mask + 1)).bit_length() - 1
        runs.append((at + zeros, at + zeros + ones))
        mask >>= ones
        at += zeros + ones
    return runs


def deduplicate(docs: DataFrame, window: int = WINDOW, hot: int = HOT, shard_segments: int = SHARD_SEGMENTS) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept (the words that stay, joined by one space), kept_sha256.

    A word goes if a window of `window` words over it also starts anywhere else. Null and blank texts
    have no words; texts of fewer words than a window lose none; rows that repeat a doc_id are rows of
    their own (and repeat each other's windows if their texts are equal). Whole texts are searched, however
    long; an empty table gives no rows; only doc_id and text are read, so other columns cannot clash.
    """
    if not GRAM <= window <= GRAM + 62:
        raise ValueError(f"a window has {GRAM} to {GRAM + 62} words")
    rows = keyed(docs)
    marks = repeated_windows(rows, window, hot, shard_segments)
    marks = marks.groupBy("key").agg(F.collect_set(F.struct("first", "mask")).alias("marks"))

    def work(batch: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {"doc_id": batch["doc_id"]} | {k: [] for k in ("n_words", "n_removed", "kept", "kept_sha256")}
        for text, found in zip(batch["text"], batch["marks"], strict=True):
            words = words_of(text)
            delta = np.zeros(len(words) + 1, np.int64)
            runs = [(m["first"] + a, m["first"] + b) for m in found or () for a, b in runs_of(m["mask"])]
            if runs:
                begin, end = np.array(runs).T
                np.add.at(delta, begin, 1)
                np.add.at(delta, end + window - 1, -1)
            gone = np.cumsum(delta[:-1]) > 0
            kept = b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g) if found else b" ".join(words)
            out["n_words"].append(len(words))
            out["n_removed"].append(int(gone.sum()))
            out["kept"].append(kept.decode("utf-8", "replace"))
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
        return out

    joined = rows.join(marks, "key", "left").select("doc_id", "text", "marks")
    return map_texts(joined, ["doc_id", "text", "marks"], "text", "doc_id long, n_words long, n_removed long, kept string, kept_sha256 string", work)
