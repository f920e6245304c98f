"""Exact de-duplication by a 128-bit content hash, in SQL functions only.

1. Distinct (hash, normalised text) pairs are aggregated: the aggregate's keys hold the whole text, so
   texts of one hash are compared byte by byte and a collision gives two classes instead of one. Copies are
   combined before the shuffle: of a text that a third of the rows have, a map task sends one row.
2. Every class keeps the row of largest id. Rows find their class through the hash alone (24 bytes a row);
   only rows whose hash has several classes are matched by their text as well.

The classes are written without texts, so the joins move narrow rows, and a hash that very many rows share
is split by AQE, because the classes' side is unique.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import checkpointed

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: Column) -> Column:
    """A-Z lower-cased, nothing else changed; null is the empty text."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def content_hash(text: Column) -> Column:
    """128 bits of the text's UTF-8 bytes."""
    return F.unhex(F.md5(text.cast("binary")))


def classes(docs: DataFrame, hashed: Callable[[Column], Column] = content_hash) -> DataFrame:
    """One row per distinct normalised text: (hash, text, keep_id, group_size)."""
    rows = docs.select("doc_id", normalised(F.col("text")).alias("text"))
    rows = rows.select("doc_id", hashed(F.col("text")).alias("hash"), "text")
    return rows.groupBy("hash", "text").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))


def duplicates(docs: DataFrame, hashed: Callable[[Column], Column] = content_hash) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256 (lower-case hex of the normalised text).

    Null and empty texts are equal. Of equal texts the row with the largest doc_id stays; rows without
    doc_id stay only where no row of their class has one (keep_id is then null). Rows that repeat doc_id
    and text are copies like others, and exactly one row of a class is kept. Whole texts are compared,
    however long. An empty table gives no rows; only doc_id and text are read, so other columns cannot
    clash. `hashed` may be any function of the text: a worse one costs time, not correctness.
    """
    found = classes(docs, hashed)
    digest = F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256")
    marked = checkpointed(found.select("hash", "keep_id", "group_size", digest))
    several = checkpointed(marked.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash"))

    # Of rows that repeat the largest doc_id the first one stays; numbers are written once, so a re-run keeps them.
    numbered = docs.select(F.monotonically_increasing_id().alias("row_no"), "doc_id", hashed(normalised(F.col("text"))).alias("hash"))
    ids = checkpointed(numbered)
    best = ids.groupBy("hash").agg(F.max(F.struct("doc_id", (-F.col("row_no")).alias("place"))).alias("best"))
    single, alone = ids, marked
    if not several.isEmpty():
        single, alone = ids.join(several, "hash", "left_anti"), marked.join(several, "hash", "left_anti")
    placed = checkpointed(alone.join(best.select("hash", (-F.col("best.place")).alias("keep_row")), "hash"))
    kept = F.col("row_no") == F.col("keep_row")
    unmixed = single.join(placed, "hash").select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")
    if several.isEmpty():
        return unmixed
    texts = docs.select("doc_id", normalised(F.col("text")).alias("text"))
    texts = texts.select("doc_id", hashed(F.col("text")).alias("hash"), "text").join(several, "hash", "left_semi")
    own = found.join(several, "hash", "left_semi").select("hash", "text", "keep_id", "group_size", digest)
    counted = texts.groupBy("doc_id", "hash", "text").agg(F.count("*").alias("copies"))
    mixed = counted.join(own, ["hash", "text"]).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    first = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return unmixed.unionByName(mixed.select("doc_id", "keep_id", "group_size", first.alias("kept"), "text_sha256"))


def keep_one(docs: DataFrame, hashed: Callable[[Column], Column] = content_hash) -> DataFrame:
    """`docs` with one row of each class of equal texts, all columns as they are: the row `duplicates` keeps.

    Of rows that repeat the kept doc_id and text, the one of smallest row hash over all columns stays.
    """
    names = docs.columns
    spare = "_".join(["row", *names])
    text = normalised(F.col("text"))
    order = F.struct(F.col("doc_id"), -F.xxhash64(*[F.to_json(F.struct(F.col(n))) for n in names]).cast("decimal(20,0)"))
    numbered = docs.select("*", F.struct(hashed(text).alias("hash"), text.alias("text"), order.alias("place")).alias(spare))
    best = numbered.groupBy(F.col(f"{spare}.hash").alias("h"), F.col(f"{spare}.text").alias("t")).agg(F.max(f"{spare}.place").alias("p"))
    best = checkpointed(best.select("h", F.sha2(F.col("t").cast("binary"), 256).alias("s"), "p"))
    same = (
        (F.col(f"{spare}.hash") == F.col("h"))
        & F.col(f"{spare}.place").eqNullSafe(F.col("p"))
        & (F.sha2(F.col(f"{spare}.text").cast("binary"), 256) == F.col("s"))
    )
    return numbered.join(best, same, "left_semi").dropDuplicates([spare]).drop(spare)
