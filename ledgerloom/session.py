"""Session settings the plans are written for."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime settings that affect results or plan quality. Sizes are left to the cluster, except the
# advisory partition size that AQE aims for after a shuffle.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    # Of a member named twice in a JSON object the last one counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


ADVISORY_BYTES = 128 << 20


def configure(spark: SparkSession, shuffle_bytes: int | None = None) -> SparkSession:
    """Apply the runtime settings to an existing session.

    `shuffle_bytes` is the largest amount of data a run is expected to shuffle. AQE merges shuffle
    partitions but does not add any, so they are started at the advisory size for that amount.
    """
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    if shuffle_bytes is not None:
        partitions = max(200, -(-shuffle_bytes // ADVISORY_BYTES))
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return spark


#: Shuffle partitions at most: beyond it the driver's bookkeeping costs more than larger partitions do.
MOST_PARTITIONS = 20_000


@contextmanager
def widened_shuffles(spark: SparkSession, input_bytes: int) -> Iterator[None]:
    """Inside, shuffles start at the advisory size for an input of so many bytes: never at fewer partitions
    than set, and at MOST_PARTITIONS at most. The setting is put back afterwards."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    wanted = min(-(-input_bytes // ADVISORY_BYTES), MOST_PARTITIONS)
    if wanted > int(before):
        spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def work_folder(spark: SparkSession, name: str = "ledgerloom") -> str:
    """A new folder below the cluster's shared one; only a local master may go without `spark.checkpoint.dir`."""
    shared = spark.conf.get("spark.checkpoint.dir", "")
    if not shared:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        return tempfile.mkdtemp(prefix=f"{name}-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ledgerloom")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        # Call-site capture costs several driver round trips per column of a wide plan.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
