"""Parquet tables under one base path, registered in one catalog database."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from tablekit.functions.columns import fold_case, quote, quoted
from tablekit.session import path_exists, qualified, sized_shuffles
from tablekit.sinks import publication as publishing
from tablekit.sinks.files import FileStore
from tablekit.sinks.publication import ADD, PARTITIONS, REPLACE, TABLE_NOTE, Publication, Step

_SIDE = "__side"

# Below this share of the other side the rows put aside are shuffled together before
# they are stored: every task of the scan would leave a tiny file otherwise.
FEW_ASIDE = 0.1

MODES = ("append", "overwrite", "overwrite_partitions")

# What each numeric type holds to the last digit, besides its own values.
_EXACTLY_HELD = {
    T.ShortType(): {T.ByteType()},
    T.IntegerType(): {T.ByteType(), T.ShortType()},
    T.LongType(): {T.ByteType(), T.ShortType(), T.IntegerType()},
    T.FloatType(): {T.ByteType(), T.ShortType()},
    T.DoubleType(): {T.ByteType(), T.ShortType(), T.IntegerType(), T.FloatType()},
}
# Types a column may grow to, from narrow to wide.
_WIDER = (T.ShortType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.TimestampNTZType(), T.TimestampType())
_WHOLE = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())


class SchemaConflict(ValueError):
    """The stored column can neither hold the new column's values as they are nor grow to
    a type that holds both."""


@dataclass(frozen=True)
class TableSink:
    """Writes ``<base_path>/<table>`` and keeps ``<database>.<table>`` up to date."""

    spark: SparkSession
    database: str
    base_path: str

    def root(self) -> str:
        return qualified(self.spark, self.base_path)

    def path(self, table: str) -> str:
        return f"{self.root()}/{table}"

    def name(self, table: str) -> str:
        return f"{quote(self.database)}.{quote(table)}"

    def save(
        self,
        df: DataFrame,
        table: str,
        partition_by: Sequence[str] = (),
        mode: str = "append",
        rebalance: bool | None = None,
    ) -> int:
        """Write ``df`` to one table, as ``TableRun.write`` does, and publish it."""
        with self.run([table]) as run:
            return run.write(df, table, partition_by, mode, rebalance)

    def clear(self, table: str) -> None:
        """Empty a stored table, if there is one; its columns stay."""
        with self.run([table]) as run:
            run.clear(table)

    @contextmanager
    def run(self, tables: Sequence[str], name: str | None = None) -> Iterator[TableRun]:
        """Write to several tables and publish all of it at the end, or nothing of it if
        the context is left by an exception or the run is killed.

        A run with a name is done once: ``done`` tells what it noted.
        """
        self._ensure_database()
        with publishing.publication(self, tables, name) as publication:
            yield TableRun(self, publication)

    def done(self, name: str) -> dict | None:
        """The notes of a named run, None if there was none or it was killed before all
        its data was there."""
        self._ensure_database()
        return publishing.notes_of(self, name)

    def remove_unpublished(self) -> None:
        """Remove what killed runs left; only while no run is under way."""
        publishing.remove_unpublished(self)

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table)) or self._adopt(table)

    def partitions_of(self, table: str) -> list[str]:
        return [c.name for c in self.spark.catalog.listColumns(self.name(table)) if c.isPartition]

    def _ensure_database(self) -> None:
        location = self.root().replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {quote(self.database)} LOCATION '{location}'")

    def _adopt(self, table: str) -> bool:
        """Register files an earlier session left at the table's path, if any."""
        if not path_exists(self.spark, self.path(table)):
            return False
        if note := FileStore(self.spark).read_json(f"{self.path(table)}/{TABLE_NOTE}"):
            publishing.create(self, table, **note)
            return True
        catalog = self.spark.catalog
        catalog.createTable(self.name(table), path=self.path(table), source="parquet", mergeSchema="true")
        if self.partitions_of(table):
            catalog.recoverPartitions(self.name(table))
        return True


@dataclass(frozen=True)
class _Plan:
    """``before`` counts stored rows that are written again."""

    df: DataFrame
    by: list[str]
    action: str
    before: int = 0


class TableRun:
    """Writes of one run, none of them to be seen before all are."""

    def __init__(self, sink: TableSink, publication: Publication):
        self._sink, self._publication = sink, publication

    @property
    def notes(self) -> dict:
        """What a named run leaves to be read with ``TableSink.done``."""
        return self._publication.notes

    def write(
        self,
        df: DataFrame,
        table: str,
        partition_by: Sequence[str] = (),
        mode: str = "append",
        rebalance: bool | None = None,
    ) -> int:
        """Write ``df``, adding columns the stored table lacks and widening those that
        have to hold more; returns the rows written.

        ``append`` adds files, also on a re-run. ``overwrite`` replaces the table;
        ``overwrite_partitions`` replaces only the partitions ``df`` has rows for.
        ``rebalance`` shuffles the rows into files of even size, by partition if the
        table has any. It is the default for those; turn it off for input laid out
        that way already, turn it on where each task has few rows to write.
        """
        plan = self._planned(df, table, partition_by, mode)
        rows = self._stage(plan.df, self._publication.new(table), plan.by, partition_by, rebalance, {"rows": F.lit(True)})["rows"]
        self._publication.steps.append(Step(table, plan.action, _ddl(plan.df, plan.by), plan.by))
        return rows - plan.before

    def write_sides(
        self,
        judged: DataFrame,
        aside: str,
        table: str,
        aside_table: str,
        partition_by: Sequence[str] = (),
        mode: str = "append",
        rebalance: bool | None = None,
    ) -> tuple[int, int]:
        """Write two tables in one pass over their source: rows whose struct ``aside`` is
        null go to ``table`` without it, the fields of the others to ``aside_table``.

        The pass writes both sides to folders of their own; the second is read back from
        there to be stored, so it should be the smaller one. Returns the rows of each.
        """
        plan = self._planned(judged, table, partition_by, mode, carried=aside)
        both, goes_aside = f"{self._publication.folder}/both/{table}", F.col(aside).isNotNull()
        side = F.when(goes_aside, "aside").otherwise("table").alias(_SIDE)
        sides = plan.df.select("*", side)
        counts = self._stage(sides, both, [_SIDE, *plan.by], partition_by, rebalance, {"rows": ~goes_aside, "aside": goes_aside})
        files, new = FileStore(self._sink.spark), self._publication.new(table)
        kept = plan.df.drop(aside)
        if files.exists(f"{both}/{_SIDE}=table"):
            files.move(f"{both}/{_SIDE}=table", new)
        else:
            self._empty(kept).write.partitionBy(*plan.by).parquet(new)
        self._publication.steps.append(Step(table, plan.action, _ddl(kept, plan.by), plan.by))
        others = judged.select(f"{aside}.*")
        if counts["aside"]:
            # the one column that this side has values in
            found = self._sink.spark.read.schema(judged.select(aside).schema).parquet(f"{both}/{_SIDE}=aside")
            others = found.select(f"{aside}.*")
        else:
            others = self._empty(others)
        # errors have no partitions: those of partitions that are not written stay
        keep = "append" if mode == "overwrite_partitions" else mode
        self.write(others, aside_table, mode=keep, rebalance=counts["aside"] < FEW_ASIDE * counts["rows"])
        return counts["rows"] - plan.before, counts["aside"]

    def _empty(self, like: DataFrame) -> DataFrame:
        return self._sink.spark.createDataFrame([], like.schema)

    def _stage(
        self, df: DataFrame, path: str, folders: Sequence[str], partition_by: Sequence[str], rebalance: bool | None, counted: dict[str, Column]
    ) -> dict[str, int]:
        """Write to a folder of the run and count rows on the way."""
        if bool(partition_by) if rebalance is None else rebalance:
            df = _rebalanced(df, partition_by)
        # Counted last, in the tasks that write: a stage run again after a lost
        # executor would count its rows twice.
        written = Observation()
        writer = df.observe(written, *[F.count_if(c).alias(name) for name, c in counted.items()]).write
        with sized_shuffles(df):
            writer.partitionBy(*folders).parquet(path)
        return written.get

    def _planned(self, df: DataFrame, table: str, partition_by: Sequence[str], mode: str, carried: str | None = None) -> _Plan:
        """What to write, by which columns, and what is to happen with it. ``carried`` is a
        column that only passes through."""
        sink = self._sink
        if mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
        if not df.columns:
            raise ValueError(f"no columns to write to {table}")
        if mode == "overwrite" or not sink.exists(table):
            return _Plan(df, list(partition_by), REPLACE)
        by = self._stored_partitions(table, partition_by, mode)
        stored, own, passing = sink.spark.table(sink.name(table)), df, []
        if carried:
            own, passing = df.drop(carried), [F.col(carried)]
        wanted = [_target(sink.spark, own, f, f.name in by) for f in stored.schema.fields] + _new_fields(own, stored)
        fitted = df.select(*[_fit(own, f).alias(f.name) for f in wanted], *passing)
        if not any(_needs_rewrite(old.dataType, new.dataType) for old, new in zip(stored.schema.fields, wanted)):
            return _Plan(fitted, by, PARTITIONS if mode == "overwrite_partitions" else ADD)
        if mode == "overwrite_partitions":
            raise SchemaConflict(f"{table} must be rewritten to hold the new types; use append or overwrite")
        rewritten = stored.select(*[_fit(stored, f).alias(f.name) for f in wanted])
        return _Plan(fitted.unionByName(rewritten, allowMissingColumns=True), by, REPLACE, stored.count())

    def clear(self, table: str) -> None:
        """Empty a stored table, if there is one; its columns stay."""
        if self._sink.exists(table):
            schema = self._sink.spark.table(self._sink.name(table)).schema
            empty = self._sink.spark.createDataFrame([], schema)
            self.write(empty, table, self._sink.partitions_of(table), "overwrite", rebalance=False)

    def _stored_partitions(self, table: str, partition_by: Sequence[str], mode: str) -> list[str]:
        stored = self._sink.partitions_of(table)
        if mode == "overwrite_partitions" and not stored:
            raise ValueError(f"{table} has no partitions to overwrite; use overwrite or append")
        fold = lambda names: [fold_case(self._sink.spark, n) for n in names]
        if partition_by and fold(partition_by) != fold(stored):
            raise ValueError(f"{table} is stored by {stored}, not by {list(partition_by)}")
        return stored


def _rebalanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Bring rows of one table partition together, so that few tasks write to it.

    The outcome of a ``rebalance`` shuffle is sized by AQE: it merges small partitions
    and splits one that a hot value makes too large, where a plain ``repartition``
    would send that value to a single task.
    """
    return df.hint("rebalance", *[quoted(c) for c in partition_by])


def _ddl(df: DataFrame, partition_by: Sequence[str]) -> str:
    """The columns as a table with these partitions has them: partitions last."""
    fold = lambda name: fold_case(df.sparkSession, name)
    last = {fold(c): i for i, c in enumerate(partition_by)}
    missing = set(last) - {fold(c) for c in df.columns}
    if missing:
        raise ValueError(f"no column to partition by: {sorted(missing)}")
    ordered = sorted(df.columns, key=lambda c: last.get(fold(c), -1))
    return df.select(*map(quoted, ordered))._jdf.schema().asNullable().toDDL()


def _arriving(df: DataFrame, name: str) -> T.StructField | None:
    return next((f for f in df.schema.fields if fold_case(df.sparkSession, f.name) == fold_case(df.sparkSession, name)), None)


def _new_fields(df: DataFrame, stored: DataFrame) -> list[T.StructField]:
    return [f for f in df.schema.fields if _arriving(stored, f.name) is None]


def _target(spark: SparkSession, df: DataFrame, stored: T.StructField, partition: bool) -> T.StructField:
    """The stored column, with the first type that holds its values and the new ones."""
    found = _arriving(df, stored.name)
    if found is None or _holds(stored.dataType, found.dataType):
        return stored
    # a partition's folder is named by its value: 1 must not become 1.0 there
    allowed = _WHOLE if partition else _WIDER
    for wider in _WIDER:
        if wider in allowed and _holds(wider, stored.dataType) and _holds(wider, found.dataType):
            return T.StructField(stored.name, wider)
    raise SchemaConflict(
        f"column {stored.name}: the table stores {stored.dataType.simpleString()}, "
        f"the frame has {found.dataType.simpleString()}"
    )


def _needs_rewrite(stored: T.DataType, wanted: T.DataType) -> bool:
    """Whether files of the stored type cannot be read under the wanted one. Parquet
    readers turn smaller whole numbers and floats into larger ones, but no dates into
    points in time, which depend on the session's zone."""
    return stored != wanted and isinstance(wanted, T.TimestampType)


def _fit(df: DataFrame, wanted: T.StructField) -> Column:
    found = _arriving(df, wanted.name)
    return (F.lit(None) if found is None else quoted(found.name)).cast(wanted.dataType)


def _holds(stored: T.DataType, arriving: T.DataType) -> bool:
    if stored == arriving or isinstance(arriving, T.NullType):
        return True
    if isinstance(stored, T.StringType):
        return isinstance(arriving, T.AtomicType)
    if isinstance(stored, (T.TimestampType, T.TimestampNTZType)):
        return isinstance(arriving, T.DateType)
    return arriving in _EXACTLY_HELD.get(stored, ())
