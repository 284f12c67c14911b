"""Several tables written in one go: all of them or none, also if a run is killed.

Data is written to a folder of the run first. When all of it is there, a manifest says
what goes where: from then on the run counts as done, and whoever writes to one of its
tables next completes what is left. Without a manifest nothing of the run has reached a
table. Each step can be repeated, so it does not matter where a run was killed.

    <base>/_runs/<run>/manifest.json     the steps, once all data is there
    <base>/_runs/<run>/new/<table>       data on its way in
    <base>/_runs/<run>/both/<table>      both sides of a write, before they are parted
    <base>/_runs/<run>/old/<table>       data on its way out
    <base>/_runs/<run>/done.json         what a named run did; kept, so it is done once
    <base>/<table>/_table.json           columns and partitions as the catalog has them

One run at a time may write to a table; runs on different tables do not meet. Moves are
renames, which object stores carry out as copies.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import asdict, dataclass, field
from typing import TYPE_CHECKING
from uuid import uuid4

from pyspark.sql import types as T

from tablekit.functions.columns import quote
from tablekit.sinks.files import FileStore

if TYPE_CHECKING:
    from tablekit.sinks.tables import TableSink

# Names below the base path; those with an underscore are no data to Spark.
RUNS, MANIFEST, DONE, TABLE_NOTE = "_runs", "manifest.json", "done.json", "_table.json"
ADD, REPLACE, PARTITIONS = "add", "replace", "partitions"


@dataclass
class Step:
    """What happens to one table: new files added, the whole of it replaced, or the
    partitions that are among the new files. ``columns`` is the table's schema as DDL."""

    table: str
    action: str
    columns: str
    partition_by: list[str] = field(default_factory=list)


class Publication:
    """What one run has written so far, and the steps that will bring it into place."""

    def __init__(self, sink: TableSink, folder: str, name: str | None):
        self.sink, self.folder, self.name = sink, folder, name
        self.steps: list[Step] = []
        self.notes: dict = {}

    def new(self, table: str) -> str:
        return f"{self.folder}/new/{table}"

    def publish(self) -> None:
        manifest = {"steps": [asdict(s) for s in self.steps], "notes": self.notes, "name": self.name}
        FileStore(self.sink.spark).write_json(f"{self.folder}/{MANIFEST}", manifest)
        _complete(self.sink, self.folder, again=False)


@contextmanager
def publication(sink: TableSink, tables: Sequence[str], name: str | None = None) -> Iterator[Publication]:
    """Publish what was written to the tables inside the context, or nothing of it.

    Killed runs that had all their data for one of the tables are completed first.
    """
    complete_runs_on(sink, tables)
    files, folder = FileStore(sink.spark), f"{sink.root()}/{RUNS}/{name or uuid4().hex}"
    files.remove(folder)
    run = Publication(sink, folder, name)
    try:
        yield run
    except BaseException:
        files.remove(folder)
        raise
    if run.steps or name:
        run.publish()


def notes_of(sink: TableSink, name: str) -> dict | None:
    """What a named run noted when it was done; None if it is not."""
    files, folder = FileStore(sink.spark), f"{sink.root()}/{RUNS}/{name}"
    _complete(sink, folder, again=True)
    return files.read_json(f"{folder}/{DONE}")


def complete_runs_on(sink: TableSink, tables: Sequence[str]) -> None:
    """Complete killed runs whose manifest names one of the tables."""
    files, runs = FileStore(sink.spark), f"{sink.root()}/{RUNS}"
    for run, _ in files.names(runs):
        manifest = files.read_json(f"{runs}/{run}/{MANIFEST}")
        if manifest and {s["table"] for s in manifest["steps"]} & set(tables):
            _complete(sink, f"{runs}/{run}", again=True)


def remove_unpublished(sink: TableSink) -> None:
    """Remove what killed runs wrote without getting to a manifest. Only while no run is
    under way, as nothing tells one that is from one that was killed."""
    files, runs = FileStore(sink.spark), f"{sink.root()}/{RUNS}"
    for run, _ in files.names(runs):
        if not any(files.exists(f"{runs}/{run}/{note}") for note in (MANIFEST, DONE)):
            files.remove(f"{runs}/{run}")


def _complete(sink: TableSink, folder: str, again: bool) -> None:
    """Carry out what a manifest asks for and has not been done yet."""
    files = FileStore(sink.spark)
    manifest = files.read_json(f"{folder}/{MANIFEST}")
    if manifest is None:
        return
    for step in manifest["steps"]:
        _carry_out(sink, files, folder, Step(**step), again)
    if manifest["name"] is None:
        files.remove(folder)
        return
    files.write_json(f"{folder}/{DONE}", manifest["notes"])
    for left, _ in files.names(folder):
        if left != DONE:
            files.remove(f"{folder}/{left}")


def _carry_out(sink: TableSink, files: FileStore, folder: str, step: Step, again: bool) -> None:
    new, old, at = f"{folder}/new/{step.table}", f"{folder}/old/{step.table}", sink.path(step.table)
    if step.action == REPLACE:
        # new data that is gone has been moved already, before the run was killed
        if files.exists(new):
            if files.exists(at):
                files.move(at, old)
            files.move(new, at)
        _register(sink, step, anew=True)
        return
    _register(sink, step, anew=False)
    arriving = list(files.files_below(new))
    moves, added = [], again
    for inside in sorted({name.rpartition("/")[0] for name in arriving}):
        target = f"{at}/{inside}".rstrip("/")
        if step.action == PARTITIONS and files.exists(target):
            files.move(target, f"{old}/{inside}")
        elif not files.exists(target):
            added = True
        if files.exists(target):
            moves += [(f"{new}/{f}", f"{at}/{f}") for f in arriving if f.rpartition("/")[0] == inside]
        else:
            moves.append((f"{new}/{inside}", target))
    files.move_all(moves)
    if step.partition_by and added:
        sink.spark.catalog.recoverPartitions(sink.name(step.table))
    sink.spark.catalog.refreshTable(sink.name(step.table))


def _register(sink: TableSink, step: Step, anew: bool) -> None:
    """Make the catalog show the table with the step's columns. Files that lack columns,
    or hold narrower types, are read under them as they are."""
    name, sql = sink.name(step.table), sink.spark.sql
    wanted = T.StructType.fromDDL(step.columns).fields
    stored = [] if anew else sink.spark.table(name).schema.fields
    if stored and stored == wanted:
        return
    kept = [f for f in wanted if f.name not in step.partition_by]
    as_before = [f for f in stored if f.name not in step.partition_by]
    if stored and kept[: len(as_before)] == as_before and stored[len(as_before) :] == wanted[len(kept) :]:
        more = ", ".join(f"{quote(f.name)} {f.dataType.simpleString()}" for f in kept[len(as_before) :])
        sql(f"ALTER TABLE {name} ADD COLUMNS ({more})")
    else:
        create(sink, step.table, step.columns, step.partition_by)
    note = {"columns": step.columns, "partition_by": step.partition_by}
    FileStore(sink.spark).write_json(f"{sink.path(step.table)}/{TABLE_NOTE}", note)


def create(sink: TableSink, table: str, columns: str, partition_by: Sequence[str]) -> None:
    """Enter a table's folder in the catalog, in place of what the name stood for."""
    name = sink.name(table)
    sink.spark.sql(f"DROP TABLE IF EXISTS {name}")
    by = f" PARTITIONED BY ({', '.join(map(quote, partition_by))})" if partition_by else ""
    location = sink.path(table).replace("\\", "\\\\").replace("'", "\\'")
    sink.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet{by} LOCATION '{location}'")
    if partition_by:
        sink.spark.catalog.recoverPartitions(name)
