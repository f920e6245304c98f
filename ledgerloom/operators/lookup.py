"""Many-to-one joins that stay balanced when one key holds a large share of the rows.

A foreign key may be hot: a third of the parents can point at the same child, or at none. Catalyst
broadcasts the child when its planned size is under the session's threshold, and then no key can be
hot. Above the threshold the lookup is salted:

* hot keys are found by counting the key column alone (partial aggregates, a narrow shuffle), or, for
  several foreign keys of one parent, by a mergeable sketch of each key in one aggregate;
* the rows of a hot key are spread over as many salts as it has multiples of `hot_rows`, by a hash of
  the parent's own identity, which gives the same salt when a lost task is run again;
* only the child rows of hot keys are repeated, once per salt, so no more than
  2 * (parent rows / hot_rows) rows are added in total;
* rows without a key match nothing; each gets a salt of its own, so they spread evenly.

The frame of hot keys is broadcast. It has at most (parent rows / hot_rows) narrow rows, and never more
than MAX_HOT: of more hot keys the largest are salted. The others are joined as they are, which gives
the same rows and leaves large partitions to AQE.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000
MAX_SALT = (1 << 31) - 1
MAX_HOT = 100_000
#: Most frequent keys that a sketch reports, and keys that it tracks. A key is sure to be reported if it
#: has over 4 / TRACKED of the rows; one that is missed is joined unsalted, with the same result.
SKETCHED, TRACKED = 10_000, 65_536


@dataclass(frozen=True)
class SkewPolicy:
    """When to salt and how far. Values left out are taken from the session: the broadcast threshold
    and `ledgerloom.lookup.hotRows`."""

    broadcast_bytes: int | None = None
    hot_rows: int | None = None

    def broadcast_limit(self, spark: SparkSession) -> int:
        if self.broadcast_bytes is not None:
            return self.broadcast_bytes
        return size_in_bytes(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760"))

    def hot_limit(self, spark: SparkSession) -> int:
        return self.hot_rows or int(spark.conf.get("ledgerloom.lookup.hotRows", str(HOT_ROWS)))


DEFAULT_POLICY = SkewPolicy()


def size_in_bytes(text: str) -> int:
    """Bytes of a size setting such as '10MB', '64k' or '10485760b'."""
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}
    value = text.strip().lower().removesuffix("b")
    scale = units.get(value[-1:], 1)
    return int(value.rstrip("kmgt")) * scale


def planned_bytes(frame: DataFrame) -> int:
    """Catalyst's size estimate, the one it compares with the broadcast threshold."""
    return int(frame._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def is_small(frame: DataFrame, policy: SkewPolicy = DEFAULT_POLICY) -> bool:
    """Whether Catalyst will broadcast the frame by itself; nothing is hinted."""
    return planned_bytes(frame) <= policy.broadcast_limit(frame.sparkSession)


def lookup(
    parent: DataFrame,
    child: DataFrame,
    on: Mapping[str, str],
    how: str = "left",
    spread_by: Sequence[str] = ("id",),
    policy: SkewPolicy = DEFAULT_POLICY,
    key_source: DataFrame | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Join each parent row to the child row of its key; child keys are dropped from the result.

    The child holds one row per key for left and inner joins. `key_source` may give a cheaper frame
    to count keys on than the parent's own plan; it needs the parent key columns only. With `hot`, a
    frame as `hot_keys` returns it, nothing is counted.
    """
    spark = parent.sparkSession
    keys = {parent_key: f"_key_{i}" for i, parent_key in enumerate(on)}
    child = child.withColumnsRenamed({on[k]: keys[k] for k in on})
    if is_small(child, policy):
        return parent.join(child, _equal(keys), how).drop(*keys.values())

    named = {k: f"_hot_{i}" for i, k in enumerate(on)}
    if hot is None:
        hot = hot_keys(parent if key_source is None else key_source, list(on), policy.hot_limit(spark))
    hot = hot.withColumnsRenamed(named)
    own = F.xxhash64(*spread_by)
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in on])
    place = (
        F.when(no_key, F.pmod(own, F.lit(MAX_SALT)))
        .when(F.col("_salts").isNotNull(), F.pmod(own, F.col("_salts")))
        .otherwise(F.lit(0))
    )
    copies = F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)
    spread = _flag_hot(parent, hot, on).withColumn("_salt", place.cast("int")).drop("_salts")
    repeated = (
        _flag_hot(child, hot, keys.values())
        .withColumn("_child_salt", F.explode(copies))
        .drop("_salts")
    )
    matched = spread.join(repeated, _equal(keys) & (F.col("_salt") == F.col("_child_salt")), how)
    return matched.drop("_salt", "_child_salt", *keys.values())


@dataclass(frozen=True)
class Lookup:
    """A child frame with one row per key; `on` maps parent columns to child columns."""

    child: DataFrame
    on: Mapping[str, str]


def lookups(
    parent: DataFrame,
    wanted: Sequence[Lookup],
    key_source: DataFrame,
    key: str = "id",
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Several left lookups for a wide parent that is joined on its own unique key as well.

    Small children are broadcast onto the parent. For the others only the parent's key and foreign
    keys, read from `key_source`, go through the salted joins; what was found is attached by the key.
    So the wide rows are moved once, by their own key, however many large lookups there are. Both ways
    give one row per parent row, also where keys repeat.
    """
    large = []
    for item in wanted:
        if is_small(item.child, policy):
            parent = lookup(parent, item.child, item.on, policy=policy)
        else:
            large.append(item)
    if not large:
        return parent
    foreign = list(dict.fromkeys(k for item in large for k in item.on))
    # One row per key and foreign keys: a repeated key must find what each of its rows points at, once.
    found = key_source.select(key, *foreign).distinct()
    # All keys are sketched on these rows, so the parent is not read again for it.
    single = [k for item in large if len(item.on) == 1 for k in item.on]
    hot = sketched_hot_keys(found, single, policy.hot_limit(found.sparkSession)) if len(single) > 1 else {}
    for item in large:
        known = hot.get(next(iter(item.on))) if len(item.on) == 1 else None
        found = lookup(found, item.child, item.on, "left", (key,), policy, key_source, known)
    named = {key: "_found_for", **{k: f"_found_{k}" for k in foreign}}
    found = found.withColumnsRenamed(named)
    # The key alone deals out the rows; the foreign keys are compared as a residual, nulls as equal.
    match = [F.col(key) == F.col("_found_for")]
    for k in foreign:
        mine, theirs = F.col(k), F.col(named[k])
        # Written with bounds, so that Catalyst does not deal out the rows by it.
        match.append(mine.isNull() & theirs.isNull() | ((mine >= theirs) & (mine <= theirs)))
    return parent.join(found, reduce(lambda a, b: a & b, match), "left").drop(*named.values())


def hot_keys(source: DataFrame, keys: Sequence[str], at_least: int) -> DataFrame:
    """Keys held by at least so many rows, with the number of salts `_salts` they are spread over."""
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    counted = source.where(present).groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    salts = F.ceil(F.col("_rows") / at_least).cast("int")
    largest = counted.where(F.col("_rows") >= at_least).orderBy(F.desc("_rows"), *keys).limit(MAX_HOT)
    return largest.select(*keys, salts.alias("_salts"))


def sketched_hot_keys(source: DataFrame, keys: Sequence[str], at_least: int) -> dict[str, DataFrame]:
    """`hot_keys` of several key columns from one pass: a frame for each column.

    Every column has a heavy-hitter sketch of bounded size; sketches are merged on the way to one row. The
    counts are estimates: they decide how far a key is spread, never what it is joined to.
    """
    kinds = dict(source.dtypes)
    text = "array<struct<item: string, count: bigint>>"
    sketches = source.agg(*[F.expr(f"approx_top_k(`{k}`, {SKETCHED}, {TRACKED})").cast(text).alias(k) for k in keys])
    # One array of all of them: no column can be pruned, so every frame below is the same aggregate.
    every = sketches.select(F.explode(F.array(*[F.struct(F.lit(k).alias("key"), F.col(k).alias("top")) for k in keys])).alias("of"))
    rows = every.select("of.key", F.explode("of.top").alias("top")).select("key", "top.*")
    salts = F.ceil(F.col("count") / at_least).cast("int").alias("_salts")
    frequent = rows.where(F.col("item").isNotNull() & (F.col("count") >= at_least))
    return {k: frequent.where(F.col("key") == k).select(F.col("item").cast(kinds[k]).alias(k), salts) for k in keys}


def _flag_hot(frame: DataFrame, hot: DataFrame, keys: Iterable[str]) -> DataFrame:
    """The frame with `_salts` of its key, null where the key is not hot.

    Both sides of a lookup join the same hot frame, so its broadcast is built once.
    """
    named = {k: f"_hot_{i}" for i, k in enumerate(keys)}
    return frame.join(F.broadcast(hot), _equal(named), "left").drop(*named.values())


def keep_related(
    child: DataFrame,
    parent: DataFrame,
    on: Mapping[str, str],
    spread_by: Sequence[str] = ("id",),
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Child rows whose parent exists (semi join); `on` maps child columns to parent columns."""
    keys = parent.select(*on.values()).distinct()
    return lookup(child, keys, on, "left_semi", spread_by, policy)


def drop_related(
    child: DataFrame,
    parent: DataFrame,
    on: Mapping[str, str],
    spread_by: Sequence[str] = ("id",),
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Child rows whose parent does not exist (anti join)."""
    keys = parent.select(*on.values()).distinct()
    return lookup(child, keys, on, "left_anti", spread_by, policy)


def attach(parent: DataFrame, gathered: DataFrame, key: str, gathered_key: str) -> DataFrame:
    """Left join on a key that is unique on both sides, so it cannot be skewed."""
    matched = parent.join(gathered, F.col(key) == F.col(gathered_key), "left")
    return matched.drop(gathered_key)


def _equal(keys: Mapping[str, str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k) == F.col(c) for k, c in keys.items()])
