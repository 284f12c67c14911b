"""The shared folder of a session, frames kept there, and the size of its shuffles."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import lru_cache
from math import ceil
from threading import Lock
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

# Input bytes one shuffle partition should stand for, and the most partitions: map
# tasks times reduce tasks is what a shuffle has to keep track of, so beyond that
# number partitions grow instead, which sorts and joins survive by spilling.
SHUFFLE_PARTITION_BYTES = 512 << 20
MOST_SHUFFLE_PARTITIONS = 50_000
_SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _local_dir(spark.sparkContext.applicationId).name


@lru_cache(maxsize=None)
def _local_dir(application_id: str) -> tempfile.TemporaryDirectory:
    return tempfile.TemporaryDirectory(prefix=f"tablekit-{application_id}-")


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid4().hex}"


def stage(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` once to ``path`` and read it from there.

    For frames that are dear to compute and read several times, such as parsed
    workbooks. Unlike a cache the copy outlives the executors that made it.
    """
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    file_system, location = _located(spark, path)
    return file_system.exists(location)


def remove_path(spark: SparkSession, path: str) -> None:
    file_system, location = _located(spark, path)
    file_system.delete(location, True)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its file system and root, so that every part of Spark that gets it
    means the same place."""
    file_system, location = _located(spark, path)
    return file_system.makeQualified(location).toString()


def _located(spark: SparkSession, path: str) -> tuple:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def input_bytes(df: DataFrame) -> int:
    """Spark's estimate of what the sources of ``df`` hold after pruning; sources it
    knows no size of, such as rows made on the driver, count nothing."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    unknown = df.sparkSession._jsparkSession.sessionState().conf().defaultSizeInBytes()
    return sum(size for size in sizes if size < unknown)


def shuffle_partitions_for(size: int) -> int:
    return min(ceil(size / SHUFFLE_PARTITION_BYTES), MOST_SHUFFLE_PARTITIONS)


@contextmanager
def sized_shuffles(df: DataFrame) -> Iterator[None]:
    """Give the shuffles of ``df`` as many partitions as its input asks for, if the
    session has set fewer. AQE merges those that turn out small, but it cannot split
    partitions that are all too large."""
    with at_least(df.sparkSession, _SHUFFLE_PARTITIONS, shuffle_partitions_for(input_bytes(df))):
        yield


# Settings raised for a while: what they were set to before, if they were, the number that
# holds without any wish, and what each user asks for.
_raised: dict[tuple[int, str], tuple[str | None, int, list[int]]] = {}
_raising = Lock()


@contextmanager
def at_least(spark: SparkSession, key: str, value: int) -> Iterator[None]:
    """A numeric setting of the session is no smaller than ``value`` for a while, nor than
    it was, be that by its default.

    Several threads may ask at once: the largest wish holds, and the setting is back at
    what it was when the last of them is done.
    """
    place = (id(spark._jsparkSession), key)

    def settle() -> None:
        before, holds, wishes = _raised[place]
        if wishes:
            spark.conf.set(key, str(max([holds, *wishes])))
            return
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
        del _raised[place]

    with _raising:
        if place not in _raised:
            _raised[place] = (spark.conf.get(key, None), int(spark.conf.get(key)), [])
        _raised[place][-1].append(value)
        settle()
    try:
        yield
    finally:
        with _raising:
            _raised[place][-1].remove(value)
            settle()
