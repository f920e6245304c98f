"""SimHash near-duplicates found by bit-sliced comparison.

`fingerprints` gives every text a 64-bit SimHash over its word shingles. `link` compares *distinct*
fingerprints only, inside buckets that agree on three of five bit bands (two differing bits touch two
bands at most, so no link is missed). A bucket of more than `SPLIT` fingerprints is split by three of
five bands of its remaining bits, after which at most 2**12 distinct fingerprints can share a bucket.
A bucket is compared bit-sliced: bit planes stand vertically in 64-bit words, carry-save counters add
up 64 distances at once, and words in which every distance exceeds the radius are abandoned.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import checkpointed, components, map_texts, text_bytes

SHINGLE, RADIUS, SEED, SPLIT = 3, 2, 42, 2048
BITS = 64
TASKS_AT_ONCE, PAIRS_AT_ONCE = 200_000, 1_000_000
ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def simhash(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The fingerprint of one text: a bit is set if it is set in over half of the shingle hashes.

    Null, empty and blank texts have fingerprint 0; with fewer words than `shingle` the whole
    sequence is the only shingle; repeated shingles count each time.
    """
    words = text_bytes(text).split()
    if not words:
        return 0
    joined, n = b" ".join(words), len(words)
    if n <= shingle:
        return xxhash.xxh64_intdigest(joined, seed)
    sizes = np.fromiter(map(len, words), np.int64, n) + 1
    ends = np.cumsum(sizes)
    starts = (ends - sizes)[: n - shingle + 1].tolist()
    stops = (ends[shingle - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts, stops, strict=True)], np.uint64)
    votes = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 65_536):
        part = np.ascontiguousarray(hashes[at : at + 65_536]).view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`columns` (long) and fp, the fingerprint as a signed long; no shuffle."""

    def work(rows: dict[str, list]) -> dict[str, list]:
        values = np.array([simhash(t, shingle) for t in rows["text"]], np.uint64).view(np.int64)
        return {c: rows[c] for c in columns} | {"fp": values}

    schema = "".join(f"{c} long, " for c in columns) + "fp long"
    return map_texts(docs, [*columns, "text"], "text", schema, work)


def band_masks(bits: list[int], bands: int = 5, keep: int = 3) -> list[int]:
    """Masks over `bits` that keep `keep` of `bands` runs; `bands - keep` differing bits leave one mask equal."""
    cuts = [len(bits) * i // bands for i in range(bands + 1)]
    parts = [sum(1 << b for b in bits[cuts[i] : cuts[i + 1]]) for i in range(bands)]
    return [sum(parts[i] for i in chosen) for chosen in combinations(range(bands), keep)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def bit_sliced_pairs(groups: list[np.ndarray], radius: int = RADIUS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of fingerprints within `radius` bits in the same group, in bounded portions.

    A unit of work is one fingerprint against one word of 64 others. Its distances are kept in
    vertical counters; a unit is dropped as soon as all of its 64 distances are over the radius.
    """
    width = max(1, (radius + 1).bit_length())
    lanes, words, owners, first = [], [], [], 0
    planes_of = []
    for group in groups:
        n = len(group)
        blocks = -(-n // 64)
        padded = np.zeros(blocks * 64, np.uint64)
        padded[:n] = group
        valid = np.zeros(blocks * 64, np.uint8)
        valid[:n] = 1
        lanes.append((padded, np.packbits(valid, bitorder="little").view(np.uint64)))
        words.append(np.tile(np.arange(blocks), n) + first)
        owners.append(np.repeat(np.arange(n), blocks) + first * 64)
        first += blocks
    if not first:
        return
    members = np.concatenate([x for x, _ in lanes])
    usable = np.concatenate([x for _, x in lanes])
    for bit in range(BITS):
        own = ((members >> np.uint64(bit)) & np.uint64(1)).astype(np.uint8)
        planes_of.append(np.packbits(own, bitorder="little").view(np.uint64))
    planes = np.stack(planes_of)
    word, owner = np.concatenate(words), np.concatenate(owners)
    # A pair is met twice; keep the units in which the owner's lane can be the smaller one.
    kept = owner // 64 <= word
    word, owner = word[kept], owner[kept]
    for at in range(0, len(word), TASKS_AT_ONCE):
        w, o = word[at : at + TASKS_AT_ONCE], owner[at : at + TASKS_AT_ONCE]
        mine = members[o]
        over = ~usable[w]
        same = o // 64 == w
        over[same] |= np.uint64(1) << (o[same] % 64).astype(np.uint64)
        counters = [np.zeros(len(w), np.uint64) for _ in range(width)]
        for bit in range(BITS):
            carry = planes[bit][w] ^ np.where((mine >> np.uint64(bit)) & np.uint64(1), ONES, np.uint64(0))
            for k in range(width):
                counters[k], carry = counters[k] ^ carry, counters[k] & carry
            over |= carry | _exceeds(counters, radius)
            if bit % 8 == 7:
                alive = np.flatnonzero(over != ONES)
                if len(alive) < len(w):
                    w, o, mine, over = w[alive], o[alive], mine[alive], over[alive]
                    counters = [c[alive] for c in counters]
                if not len(w):
                    break
        if len(w):
            for part in range(0, len(w), 20_000):
                near = np.unpackbits((~over[part : part + 20_000]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                row, lane = np.nonzero(near)
                yield members[o[part : part + 20_000][row]], members[w[part : part + 20_000][row] * 64 + lane]


def _exceeds(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose vertical counter is above `radius`."""
    above = np.zeros_like(counters[0])
    equal = np.full_like(counters[0], ONES)
    for k in reversed(range(len(counters))):
        if radius >> k & 1:
            equal &= counters[k]
        else:
            above |= equal & counters[k]
            equal &= ~counters[k]
    return above


def spanning(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """At most one link per node that joins the same nodes as the links (u, v) do."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    linked = root != np.arange(len(nodes))
    return nodes[linked], nodes[root[linked]]


def link(distinct: DataFrame, radius: int = RADIUS, split: int = SPLIT) -> DataFrame:
    """Links (u, v) that connect all fingerprints `fp` of `distinct` within `radius` bits; `radius` is 2 at most."""
    if not 0 <= radius <= 2:
        raise ValueError("the bands cover a radius of 0, 1 or 2")
    masks = band_masks(list(range(BITS)))
    keyed = distinct.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in masks])).alias("band", "key"))
    sizes = keyed.groupBy("band", "key").agg(F.count("*").alias("n")).where("n > 1")
    keyed = checkpointed(keyed.join(sizes, ["band", "key"]))
    small = keyed.where(F.col("n") <= split).select("band", F.lit(-1).alias("inner"), "key", "fp")
    deeper = F.lit(None)
    for band, mask in enumerate(masks):
        rest = [b for b in range(BITS) if not mask >> b & 1]
        keys = F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(mask | m))) for m in band_masks(rest)])
        deeper = F.when(F.col("band") == band, keys).otherwise(deeper)
    large = keyed.where(F.col("n") > split).select("band", "fp", F.posexplode(deeper).alias("inner", "key"))
    buckets = (
        small.unionByName(large)
        .groupBy("band", "inner", "key")
        .agg(F.collect_list("fp").alias("fps"))
        .where(F.size("fps") > 1)
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups = [np.array(x, np.int64).view(np.uint64) for x in batch.column("fps").to_pylist()]
            u, v = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
            for a, b in bit_sliced_pairs(groups, radius):
                u, v = np.concatenate([u, a]), np.concatenate([v, b])
                if len(u) > PAIRS_AT_ONCE:
                    u, v = spanning(u, v)
            if len(u):
                u, v = spanning(u, v)
                yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

    return buckets.select("fps").mapInArrow(compare, "u long, v long")


def classes(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, root) of every distinct fingerprint `fp`: the same root for those linked over any number of steps."""
    distinct = checkpointed(prints.select("fp").distinct())
    roots = components(link(distinct, radius))
    return distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (smallest reachable doc_id).

    Empty tables give an empty frame; rows that repeat a doc_id each get a row; a null doc_id takes
    part but is a component_id only where no other id is reachable. Null, empty and blank texts have
    fingerprint 0; whole texts are hashed, however long; a bit set in exactly half of the shingles is 0.
    Only doc_id and text are read, so other columns cannot clash.
    """
    prints = checkpointed(fingerprints(docs, shingle))
    first = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    placed = checkpointed(classes(prints, radius).join(first, "fp"))
    ids = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    found = placed.join(ids, "root").select("fp", "component_id")
    return prints.join(found, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """`docs` with one row of each near-duplicate group: that of smallest doc_id (nulls last), then of smallest row hash.

    Rows that repeat both doc_id and text are one row afterwards. Null and empty texts have fingerprint
    0 and form a group like any other.
    """
    keyed = docs.withColumn("__key", F.xxhash64("doc_id", "text"))
    prints = checkpointed(fingerprints(keyed, shingle, ("doc_id", "__key")))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "__key")
    first = prints.groupBy("fp").agg(F.min(order).alias("best"))
    best = classes(prints, radius).join(first, "fp").groupBy("root").agg(F.min("best").alias("best"))
    keys = checkpointed(best.select(F.col("best")["__key"].alias("__key")))
    return keyed.join(keys, "__key", "left_semi").dropDuplicates(["__key"]).drop("__key")
