"""Exact top-k inner-product search by a three-phase uniform threshold.

A vector is cut into `LISTS` runs of dimensions; a run's inner product with a query's run is a local
score, and the sum of local scores is the score. Vectors are packed into blocks, one per list, and every
block of queries meets every block of candidates of its list through a join on (list, shard).

1. Each list gives its best local scores for a query. The sums of these vectors are resolved; the k-th
   best of them is a safe cutoff: no vector of the answer can be below it.
2. The cutoff goes back to the lists with the query. A vector that reaches it has at least one local
   score of cutoff / LISTS or more, so all such entries are sufficient.
3. Vectors whose bound (known local scores, and cutoff / LISTS for each unknown one) is below the best
   known cutoff are dropped, the scores of the others are resolved exactly, and ranked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import checkpointed

LISTS, SHARDS, DEPTH = 2, 16, 40
QUERY_BLOCK, CANDIDATE_BLOCK = 256, 4096
FACTOR = 1024
EXACT = float(1 << 53)
LONG = (1 << 63) - 1


def packed(values: list[float]) -> bytes | None:
    """floor(FACTOR * x) of the components as little-endian integers of 16 or 64 bits, saturated; None if one is not finite."""
    x = np.asarray(values, np.float64)
    if not np.isfinite(x).all():
        return None
    scaled = np.floor(FACTOR * x)
    inside = np.abs(scaled) < 2.0**63
    whole = np.where(inside, scaled, 0).astype(np.int64)
    whole[~inside] = np.where(scaled[~inside] > 0, LONG, -LONG)
    small = np.abs(whole).max(initial=0) < 1 << 15
    return b"s" + whole.astype("<i2").tobytes() if small else b"l" + whole.astype("<i8").tobytes()


def unpacked(value: bytes) -> np.ndarray:
    return np.frombuffer(value[1:], "<i2" if value[:1] == b"s" else "<i8").astype(np.int64)


def matrix(vectors: list[bytes]) -> np.ndarray:
    """Vectors as rows; a shorter one is filled with zeros, which add nothing to an inner product."""
    rows = [unpacked(v) for v in vectors]
    out = np.zeros((len(rows), max(map(len, rows), default=0)), np.int64)
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products of rows as longs: in floating point where this is exact, else in Python integers, saturated."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    bound = float(np.abs(a.astype(float)).max(initial=0)) * float(np.abs(b.astype(float)).max(initial=0)) * max(1, width)
    if bound < EXACT:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    exact = a.astype(object) @ b.T.astype(object)
    return np.clip(exact, -LONG, LONG).astype(np.int64)


def vectors(embeddings: DataFrame) -> DataFrame:
    """(row_no, vec_id, vector) of the rows that take part: an id, and a vector of finite components only."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [packed(x) if x is not None and None not in x else None for x in batch.column("embedding").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(values, pa.binary())], ["vec_id", "vector"])

    ready = embeddings.select("vec_id", "embedding").where("vec_id is not null and embedding is not null")
    made = ready.mapInArrow(work, "vec_id long, vector binary").where("vector is not null")
    return made.select(F.monotonically_increasing_id().alias("row_no"), "vec_id", "vector")


def _list_parts(vector: bytes, lists: int) -> list[bytes]:
    whole = unpacked(vector)
    cuts = [len(whole) * i // lists for i in range(lists + 1)]
    kind, size = (b"s", "<i2") if vector[:1] == b"s" else (b"l", "<i8")
    return [kind + whole[a:b].astype(size).tobytes() for a, b in zip(cuts, cuts[1:], strict=False)]


def blocks(rows: DataFrame, size: int, lists: int, carry: bool = False) -> DataFrame:
    """Rows packed, one block per list and up to `size` rows: (list, ids, vectors, cutoffs); no shuffle.

    Cuts follow a vector's own length; `search` uses a single list where lengths differ.
    """
    names = ["row_no", "vector", *(["cutoff"] if carry else [])]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def full(part: list[tuple]) -> pa.RecordBatch:
            cut = [_list_parts(x[1], lists) for x in part]
            ids = [x[0] for x in part]
            limits = [x[2] if carry else None for x in part]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(list(range(lists)), pa.int32()),
                    pa.array([ids] * lists, pa.list_(pa.int64())),
                    pa.array([[c[k] for c in cut] for k in range(lists)], pa.list_(pa.binary())),
                    pa.array([limits] * lists, pa.list_(pa.int64())),
                ],
                ["list", "ids", "vectors", "cutoffs"],
            )

        for batch in batches:
            held += list(zip(*(batch.column(n).to_pylist() for n in names), strict=True))
            while len(held) >= size:
                yield full(held[:size])
                held = held[size:]
        if held:
            yield full(held)

    return rows.select(*names).mapInArrow(work, "list int, ids array<long>, vectors array<binary>, cutoffs array<long>")


def meet(queries: DataFrame, candidates: DataFrame, shards: int) -> DataFrame:
    """Every query block beside every candidate block of its list: (q_ids, q, cutoffs, c_ids, c)."""
    left = queries.select("list", F.col("ids").alias("q_ids"), F.col("vectors").alias("q"), "cutoffs", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    right = candidates.select(
        "list", F.pmod(F.xxhash64(F.col("ids")[0]), F.lit(shards)).cast("int").alias("shard"), F.col("ids").alias("c_ids"), F.col("vectors").alias("c")
    )
    return left.join(right, ["list", "shard"]).select("list", "q_ids", "q", "cutoffs", "c_ids", "c")


def _entries(pairs: DataFrame, best: int | None, lists: int) -> DataFrame:
    """Entries (q_row, list, c_row, local): with `best`, the greatest of each query, else all of cutoff / lists or more."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
                q_ids, c_ids = np.array(row["q_ids"], np.int64), np.array(row["c_ids"], np.int64)
                local = products(matrix(row["q"]), matrix(row["c"]))
                if best is None:
                    limit = np.array([-LONG if c is None else c for c in row["cutoffs"]], np.int64)
                    # local * lists >= cutoff in whole numbers, without overflow
                    a, b = np.nonzero(local >= (-(-limit // lists))[:, None])
                else:
                    depth = min(best, local.shape[1])
                    top = np.argpartition(-local.astype(np.float64), depth - 1, axis=1)[:, :depth]
                    a, b = np.repeat(np.arange(len(q_ids)), depth), top.ravel()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q_ids[a]), pa.array(np.full(len(a), row["list"], np.int32)), pa.array(c_ids[b]), pa.array(local[a, b])],
                    ["q_row", "list", "c_row", "local"],
                )

    return pairs.mapInArrow(work, "q_row long, list int, c_row long, local long")


def resolve(pairs: DataFrame, queries: DataFrame, candidates: DataFrame) -> DataFrame:
    """Exact scores (q_row, c_row, score) of pairs (q_row, c_row)."""
    with_query = pairs.join(queries.select(F.col("row_no").alias("q_row"), F.col("vector").alias("q")), "q_row")
    with_both = with_query.join(candidates.select(F.col("row_no").alias("c_row"), F.col("vector").alias("c")), "c_row")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 20_000):
                part = batch.slice(at, 20_000)
                a, b = matrix(part.column("q").to_pylist()), matrix(part.column("c").to_pylist())
                width = min(a.shape[1], b.shape[1])
                a, b = a[:, :width], b[:, :width]
                bound = float(np.abs(a.astype(float)).max(initial=0)) * float(np.abs(b.astype(float)).max(initial=0)) * max(1, width)
                if bound < EXACT:
                    score = np.einsum("ij,ij->i", a, b)
                else:
                    score = np.clip((a.astype(object) * b.astype(object)).sum(axis=1), -LONG, LONG).astype(np.int64)
                yield pa.RecordBatch.from_arrays([part.column("q_row"), part.column("c_row"), pa.array(score, pa.int64())], ["q_row", "c_row", "score"])

    return with_both.select("q_row", "c_row", "q", "c").mapInArrow(work, "q_row long, c_row long, score long")


def _kth(scores: DataFrame, k: int) -> DataFrame:
    """(q_row, cutoff): the k-th greatest score of each query; no row for a query with fewer."""
    rank = F.row_number().over(Window.partitionBy("q_row").orderBy(F.desc("score")))
    return scores.withColumn("at", rank).where(F.col("at") == k).select("q_row", F.col("score").alias("cutoff"))


def distinct_vectors(rows: DataFrame, most: int) -> DataFrame:
    """(row_no, vector, least, members) of each distinct vector: a number of its own, the smallest vec_id and
    its `most` first rows as (vec_id, row_no). Copies beyond these are cut in every task, before the shuffle."""
    place = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id", "row_no"))
    first = rows.withColumn("place", place).where(F.col("place") <= most)
    grouped = first.groupBy("vector").agg(F.array_sort(F.collect_list(F.struct("vec_id", "row_no"))).alias("members"))
    return grouped.select(F.monotonically_increasing_id().alias("row_no"), "vector", F.col("members")[0]["vec_id"].alias("least"), "members")


def best_vectors(queries: DataFrame, candidates: DataFrame, k: int, n_queries: int, n_candidates: int, lists: int, shards: int | None, depth: int) -> DataFrame:
    """(q_row, c_row, score): the k best distinct `candidates` of each distinct query; ties go to the smaller `least`."""
    shards = shards or max(SHARDS, n_candidates // (4 * CANDIDATE_BLOCK))
    query_blocks = max(1, -(-n_queries // QUERY_BLOCK))
    spread = queries.select("row_no", "vector").repartition(query_blocks)
    candidate_blocks = blocks(candidates, CANDIDATE_BLOCK, lists)

    seen = _entries(meet(blocks(spread, QUERY_BLOCK, lists), candidate_blocks, shards), depth, lists)
    rank = F.row_number().over(Window.partitionBy("q_row", "list").orderBy(F.desc("local"), "c_row"))
    heads = seen.withColumn("at", rank).where(F.col("at") <= depth).select("q_row", "c_row").distinct()
    first = checkpointed(resolve(heads, queries, candidates))
    cutoff = checkpointed(_kth(first, k))

    limited = spread.join(cutoff.withColumnRenamed("q_row", "row_no"), "row_no", "left").repartition(query_blocks)
    entries = _entries(meet(blocks(limited, QUERY_BLOCK, lists, carry=True), candidate_blocks, shards), None, lists)
    known = checkpointed(entries.groupBy("q_row", "c_row").agg(F.sum("local").alias("score"), F.count("*").alias("n")))

    whole = known.where(F.col("n") == lists).select("q_row", "c_row", "score")
    exact = whole.unionByName(first).distinct()
    better = _kth(exact, k).withColumnRenamed("cutoff", "second").join(cutoff, "q_row")
    # score + missing lists * cutoff / lists >= second, in whole numbers
    bound = F.col("score") * lists + (lists - F.col("n")) * F.col("cutoff") >= F.col("second") * lists
    open_pairs = known.where(F.col("n") < lists).join(better, "q_row", "left").where(F.col("second").isNull() | bound)
    rest = open_pairs.select("q_row", "c_row").join(first, ["q_row", "c_row"], "left_anti")
    scored = exact.unionByName(resolve(rest, queries, candidates)).join(cutoff, "q_row", "left").where(F.col("cutoff").isNull() | (F.col("score") >= F.col("cutoff")))

    named = scored.join(candidates.select(F.col("row_no").alias("c_row"), "least"), "c_row")
    order = Window.partitionBy("q_row").orderBy(F.desc("score"), "least", "c_row")
    return named.withColumn("at", F.row_number().over(order)).where(F.col("at") <= k).select("q_row", "c_row", "score")


def search(embeddings: DataFrame, k: int = 10, query_every: int = 100, lists: int = LISTS, shards: int | None = None, depth: int = DEPTH) -> DataFrame:
    """The k best candidates of each query row: query_id, rank (from 1), vec_id, score.

    Queries are the rows whose vec_id is divisible by `query_every`, candidates all rows but the query's
    own; ties go to the smaller vec_id. Distinct vectors are searched, and equal queries once: a row of the
    answer lies in one of the k + 1 best vectors and is among the first k + 1 rows of it, so copies
    never become pairs. Rows without vec_id, without vector or with a null or non-finite component
    take no part. Rows that repeat a vec_id are rows of their own. Components and scores outside 64
    bits are saturated. Vectors of different lengths are compared as if filled with zeros, in one
    list (a cut of its own length would not match another's). Fewer than k candidates give fewer rows;
    an empty table gives none; only vec_id and embedding are read, so other columns cannot clash.
    """
    rows = checkpointed(vectors(embeddings))
    vectors_ = checkpointed(distinct_vectors(rows, k + 1))
    sizes = vectors_.agg(F.min(F.length("vector")).alias("a"), F.max(F.length("vector")).alias("b"), F.count("*").alias("n"), F.countDistinct(F.substring("vector", 1, 1)).alias("kinds")).first()
    if sizes.kinds != 1 or sizes.a != sizes.b:
        lists = 1
    asking = rows.where(F.col("vec_id") % query_every == 0).withColumnsRenamed({"row_no": "own_row", "vec_id": "query_id"})
    asked = checkpointed(asking.join(vectors_.select("row_no", "vector"), "vector").select("own_row", "query_id", F.col("row_no").alias("q_row")))
    queries = checkpointed(vectors_.join(asked.select(F.col("q_row").alias("row_no")).distinct(), "row_no", "left_semi"))
    found = best_vectors(queries, vectors_, k + 1, queries.count(), sizes.n, lists, shards, depth)

    members = vectors_.select(F.col("row_no").alias("c_row"), F.explode("members").alias("row"))
    # The first k + 1 rows of a query's vectors hold its k best besides itself, whichever row it is.
    order = Window.partitionBy("q_row").orderBy(F.desc("score"), "vec_id", "row_no")
    near = found.join(members, "c_row").select("q_row", "score", "row.vec_id", "row.row_no")
    near = near.withColumn("at", F.row_number().over(order)).where(F.col("at") <= k + 1)
    answers = asked.join(near, "q_row").where(F.col("own_row") != F.col("row_no"))
    own = Window.partitionBy("own_row").orderBy("at")
    ranked = answers.withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
