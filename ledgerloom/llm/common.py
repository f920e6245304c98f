"""Helpers shared by the operators of this package."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Characters of text handled at once inside a task; one longer text is a batch of its own.
BATCH_CHARS = 1_000_000
# Whether the shuffle files of a query are removed when it has run.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder: the session's `spark.checkpoint.dir`. Only a local master may go without one."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if not folder:
            if not context.master.startswith("local") or context.master.startswith("local-cluster"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="checkpoints-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """`df` written to the cluster's shared folder and read from there.

    The shuffle files of the run are removed at its end, as nothing reads them again; without this they
    stay until the driver collects garbage.
    """
    spark = df.sparkSession
    shared_folder(spark)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        # A plan of its own: the setting is taken, and the files are removed, by plan.
        return df.select("*").checkpoint(eager=True)
    finally:
        spark.conf.set(CLEANUP, before)


def slices(batch: pa.RecordBatch, text: str, chars: int = BATCH_CHARS) -> Iterator[dict[str, list]]:
    """The rows of a batch as column lists, cut so that the texts (or lists) of a slice hold about `chars` items.

    Only a slice at a time becomes Python objects; a single longer text is a slice of its own.
    """
    column = batch.column(text)
    length = pc.list_value_length(column) if pa.types.is_list(column.type) else pc.binary_length(column)
    sizes = pc.fill_null(length, 0).to_pylist()
    start = held = 0
    for end in range(1, batch.num_rows + 1):
        held += sizes[end - 1]
        if end == batch.num_rows or held + sizes[end] > chars:
            part = batch.slice(start, end - start)
            yield {name: part.column(name).to_pylist() for name in batch.schema.names}
            start, held = end, 0


def map_texts(
    df: DataFrame,
    columns: Sequence[str],
    text: str,
    schema: str,
    work: Callable[[dict[str, list]], dict[str, Sequence]],
    setup: Callable[[], Callable[[dict[str, list]], dict[str, Sequence]]] | None = None,
    chars: int = BATCH_CHARS,
) -> DataFrame:
    """Apply `work` (or what `setup` makes once per task) to slices of the named columns; no shuffle.

    Only `columns` are read, so further columns of `df` cannot clash with the result.
    """
    arrow = _arrow_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = setup() if setup else work
        for batch in batches:
            for rows in slices(batch, text, chars):
                out = apply(rows)
                yield pa.RecordBatch.from_arrays(
                    [_column(out[field.name], field.type) for field in arrow], schema=arrow
                )

    return df.select(*columns).mapInArrow(run, schema)


def _column(values: Sequence | pa.Array, kind: pa.DataType) -> pa.Array:
    return values if isinstance(values, pa.Array) else pa.array(values, type=kind)


def _arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def thinned(rows: DataFrame, total: int, wanted: int, place: str) -> DataFrame:
    """Of `total` rows those with the smallest values of a 64-bit hash column: half as many again as wanted, about.

    So a bounded sample sorts few rows, and no task hands on a full one. All rows where they are few.
    """
    if total <= 2 * wanted + 100:
        return rows
    share = (1.5 * wanted + 50) / total
    return rows.where(F.col(place) < F.lit(int(-(1 << 63) + share * (1 << 64))))


def text_bytes(value: str | None) -> bytes:
    """UTF-8 bytes with A-Z lower-cased; other letters are left alone."""
    return b"" if value is None else value.encode("utf-8", "surrogatepass").lower()


# Every ASCII character that is neither a digit nor a letter becomes a space.
ALNUM = bytes(
    c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256)
)


def alnum_words(value: str | None) -> list[bytes]:
    """Words of lower-cased ASCII letters, digits and non-ASCII characters."""
    return text_bytes(value).translate(ALNUM).split()


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected `edges` (u, v): one row (node, root) per node that has a link.

    Every round maps each node to the neighbour (or itself) of smallest seeded hash and contracts the
    edges along that map, so chains shrink by a constant factor. Rounds are checkpointed; minima are
    combined before the shuffle, so a node with very many links is no hot spot.
    """
    edges = checkpointed(edges.select("u", "v").where("u <> v").distinct())
    maps: list[DataFrame] = []
    seed = 0
    while not edges.isEmpty():
        seed += 1
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        rank = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(seed)), F.col(c))
        nearest = both.groupBy("u").agg(F.min(rank("v")).alias("best"))
        target = F.when(F.col("best") < rank("u"), F.col("best")[F.lit("v")]).otherwise(F.col("u"))
        step = checkpointed(nearest.select("u", target.alias("p")))
        maps.append(step)
        left = edges.join(step, "u").select(F.col("p").alias("u"), "v")
        right = left.join(step.withColumnRenamed("u", "v"), "v").select("u", F.col("p").alias("v"))
        low, high = F.least("u", "v"), F.greatest("u", "v")
        edges = checkpointed(right.where("u <> v").select(low.alias("u"), high.alias("v")).distinct())
    if not maps:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    found = maps[-1].select(F.col("u").alias("node"), F.col("p").alias("root"))
    for step in reversed(maps[:-1]):
        later = found.withColumnsRenamed({"node": "p", "root": "r"})
        found = step.join(later, "p", "left").select(
            F.col("u").alias("node"), F.coalesce("r", "p").alias("root")
        )
    return found
