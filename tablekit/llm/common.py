"""What the operators share: tables, staging in the shared folder, hashes in numpy."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekit.session import fresh_path, remove_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df``, written once to the shared folder and read from there.

    Cuts the lineage like a checkpoint; a lost executor takes nothing with it. Nothing
    reads the write's shuffle files again, so they are removed with its end.
    """
    path, conf = fresh_path(df.sparkSession, label), df.sparkSession.conf
    before = conf.get(_CLEAN_SHUFFLES)
    conf.set(_CLEAN_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(_CLEAN_SHUFFLES, before)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._staged_path = path
    if _scopes:
        _scopes[-1].append(path)
    return out


_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> bool:
    """From now on rows go to Python tasks and back in batches of some 2 MB, and a row
    that is larger by itself, unless the session has set a bound of its own. Whether that
    changed anything.

    By Spark's bound of 10,000 rows a batch of texts has tens of MB, and a task holds
    several copies of it, in the JVM outside of the heap and in its Python worker.
    """
    if spark.conf.get(_BATCH_BYTES, None) is not None:
        return False
    spark.conf.set(_BATCH_BYTES, "2m")
    return True


@contextmanager
def bounded_batches(spark: SparkSession) -> Iterator[None]:
    """The same for what runs inside; the session is left as it was."""
    changed = bound_batches(spark)
    try:
        yield
    finally:
        if changed:
            spark.conf.unset(_BATCH_BYTES)


_scopes: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """What operators stage inside is removed at the end, but for the staged frames given
    to the function it yields; those belong to the scope around this one, if any.

    A result that has not been read by then must be staged, as it may read what goes.
    """
    paths: list[str] = []
    kept: list[str] = []
    _scopes.append(paths)

    def keep(frame: DataFrame) -> DataFrame:
        kept.append(frame._staged_path)
        return frame

    try:
        yield keep
    finally:
        _scopes.remove(paths)
        if _scopes:
            _scopes[-1].extend(kept)
        for path in set(paths) - set(kept):
            remove_path(spark, path)


def discard(*frames: DataFrame) -> None:
    """Remove staged frames that nothing reads any more."""
    for frame in frames:
        remove_path(frame.sparkSession, frame._staged_path)


def crc32_text(column: str) -> Column:
    """crc32 of an id written as text, for the folds; null ids count as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def free_name(taken: Iterable[str], wanted: str) -> str:
    """A column name that clashes with none of ``taken``, whatever their case."""
    lower = {name.lower() for name in taken}
    while wanted.lower() in lower:
        wanted += "_"
    return wanted


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread the bits of each uint64 over all of it (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def odd_powers(base: int, count: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64."""
    powers = np.full(count, base, np.uint64)
    powers[:1] = 1
    return np.multiply.accumulate(powers)
