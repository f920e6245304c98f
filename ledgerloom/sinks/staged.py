"""Replacement of a data set in two phases: written aside and verified, then moved into place."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

STAGED, REPLACED = ".staged-", ".replaced-"


class IncompleteWrite(RuntimeError):
    """The footers of what was written do not hold the rows that went in."""


def _files(spark: SparkSession, path: str) -> tuple[Any, Callable[[str], Any]]:
    """The file system of a path and its path type; Spark itself cannot rename."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    return hadoop.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop.Path


def write_verified(frame: DataFrame, path: str, compression: str, partition_by: tuple[str, ...] = ()) -> int:
    """Write a new folder, compare the rows written with those in the footers, and return their number."""
    seen = Observation()
    counted = frame.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.mode("errorifexists").option("compression", compression).partitionBy(*partition_by).parquet(path)
    stored = frame.sparkSession.read.parquet(path).count()
    try:
        rows = seen.get["rows"]
    except Py4JJavaError:  # a frame found empty while running has no metrics
        rows = 0
    if stored != rows:
        raise IncompleteWrite(f"{path} holds {stored} of {rows} rows")
    return stored


def replace_folder(frame: DataFrame, path: str, compression: str) -> None:
    """Replace a folder by the rows of a frame, which may read that folder.

    The rows are written to a folder beside it. Until they are complete and verified the old folder stays as
    it is, so a job that fails loses nothing. Two renames then put the new one in its place; if the
    second fails the first is undone. On stores without renames of folders use versions and a catalog.
    """
    spark, path = frame.sparkSession, path.rstrip("/")
    mark = uuid.uuid4().hex
    staged, replaced = f"{path}{STAGED}{mark}", f"{path}{REPLACED}{mark}"
    files, at = _files(spark, path)
    try:
        write_verified(frame, staged, compression)
    except BaseException:
        files.delete(at(staged), True)
        raise
    restore_folder(spark, path)
    held = files.exists(at(path))
    if held and not files.rename(at(path), at(replaced)):
        files.delete(at(staged), True)
        raise OSError(f"{path} could not be moved aside")
    if not files.rename(at(staged), at(path)):
        if held:
            files.rename(at(replaced), at(path))
        raise OSError(f"{staged} could not be moved to {path}")
    if held:
        files.delete(at(replaced), True)


def restore_folder(spark: SparkSession, path: str) -> bool:
    """Put back what a run that died between its two renames had moved aside; True if there was such a folder."""
    path = path.rstrip("/")
    files, at = _files(spark, path)
    if files.exists(at(path)):
        return False
    aside = files.globStatus(at(f"{path}{REPLACED}*")) or []
    if not len(aside):
        return False
    newest = max(aside, key=lambda s: s.getModificationTime())
    return bool(files.rename(newest.getPath(), at(path)))
