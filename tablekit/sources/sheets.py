"""Sheets of many workbooks as DataFrames.

Spark lists and reads the files; each task turns its workbooks into rows, so the
work spreads over files (the format holds a sheet to 1,048,576 rows). One parse
serves every sheet of interest, and ``stage_sheets`` writes its rows as Parquet,
from where header, types and rules are read without touching a workbook again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from functools import partial
from hashlib import blake2b, sha256
from io import BytesIO
from threading import Lock
from typing import TYPE_CHECKING, BinaryIO
from urllib.parse import quote

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, SparkSession, functions as F

from tablekit.session import fresh_path, remove_path, stage
from tablekit.sources.inference import apply_types, narrowest
from tablekit.sources.ledger import LEDGER_COLUMNS, LOADS_SUFFIX, NothingNew, as_pattern, new_files
from tablekit.sources.masks import ColumnMasks
from tablekit.sources.xlsx import Workbook, header_names

if TYPE_CHECKING:
    from tablekit.sinks.tables import TableSink

# A row of cells, or the summary of one sheet of one workbook.
CELLS, SUMMARY = "cells", "summary"
ROWS_SCHEMA = (
    "part string, path string, sheet string, row_no bigint, layout bigint, header array<string>, cells array<string>, "
    "masks array<int>, error string, length bigint, digest string"
)
_ARROW_SCHEMA = pa.schema(
    [
        ("part", pa.string()),
        ("path", pa.string()),
        ("sheet", pa.string()),
        ("row_no", pa.int64()),
        ("layout", pa.int64()),
        ("header", pa.list_(pa.string())),
        ("cells", pa.list_(pa.string())),
        ("masks", pa.list_(pa.int32())),
        ("error", pa.string()),
        ("length", pa.int64()),
        ("digest", pa.string()),
    ]
)
_BATCH_ROWS, _BATCH_CHARS = 5000, 8 << 20
_READ_BYTES = 1 << 20

# Causes named when a sheet cannot be read; the rest are counted.
_NAMED_CAUSES = 5

# Positions of all headers together up to which every executor gets them, 64 MB.
_SENT_POSITIONS = 16 << 20


def open_workbooks(spark: SparkSession, path: str | list[str], ranged: bool = False) -> DataFrame:
    """``(path, content)`` of every workbook under ``path``; ``ranged`` leaves the content
    null, and tasks read the parts of a file that they need from where it lies.

    ``spark.sql.files.maxPartitionBytes`` bounds the file bytes in one task. A content
    takes its size in the JVM and again in Python, 2 GB at most; a file read by ranges
    has no such limit, but must lie where ``pyarrow.fs`` can open it (``file:``,
    ``hdfs:``, ``s3:``, ``gs:``).
    """
    content = F.lit(None).cast("binary").alias("content") if ranged else "content"
    return spark.read.format("binaryFile").load(path).select("path", content)


def scan_sheets(workbooks: DataFrame, sheets: Sequence[str]) -> DataFrame:
    """All rows of the named sheets, in one parse of each workbook.

    A row of cells has their texts by position; ``layout`` is a digest of its header. Each
    sheet ends with its summary: the names in ``header``, with one for every cell that
    stood beyond the header row, and in ``masks``, by position, the types that hold all
    values there. A sheet that cannot be read to its end gives a summary with the cause in
    ``error``; an unreadable workbook one for each sheet. ``length`` and ``digest``
    (SHA-256) are the workbook's.
    """
    zone = workbooks.sparkSession.conf.get("spark.sql.session.timeZone")
    parse = partial(_parse_batches, sheets=list(sheets), zone=zone)
    return workbooks.select("path", "content").mapInArrow(parse, ROWS_SCHEMA)


def _parse_batches(batches: Iterator[pa.RecordBatch], sheets: list[str], zone: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            yield from _parse_workbook(path.as_py(), content.as_py(), sheets, zone)


def _parse_workbook(path: str, content: bytes | None, sheets: list[str], zone: str) -> Iterator[pa.RecordBatch]:
    """``content`` is None for a file that is to be read by ranges."""
    file: tuple[int | None, str | None] = (None, None)
    failed = lambda sheet, cause: _record_batch([(SUMMARY, path, sheet, None, None, None, None, None, f"{type(cause).__name__}: {cause}", *file)])
    try:
        stream = BytesIO(content) if content is not None else _opened(path)
        file = _length_and_digest(stream)
        book = Workbook(stream)
    except Exception as cause:
        yield from [failed(sheet, cause) for sheet in sheets]
        return
    for sheet in sheets:
        try:
            yield from _to_batches(path, sheet, book.rows_with_kinds(sheet), zone, file)
        except Exception as cause:
            yield failed(sheet, cause)


def _opened(path: str) -> BinaryIO:
    system, place = FileSystem.from_uri(quote(path, safe=":/"))
    return system.open_input_file(place)


def _length_and_digest(stream: BinaryIO) -> tuple[int, str]:
    digest, length = sha256(), 0
    while piece := stream.read(_READ_BYTES):
        digest.update(piece)
        length += len(piece)
    stream.seek(0)
    return length, digest.hexdigest()


def _blocks(rows: Iterator) -> Iterator[list]:
    """Rows in lists that are long enough to be worth a batch and of bounded size."""
    block, size = [], 0
    for row in rows:
        block.append(row)
        size += sum(map(len, filter(None, row[1])))
        if len(block) == _BATCH_ROWS or size >= _BATCH_CHARS:
            yield block
            block, size = [], 0
    if block:
        yield block


def _to_batches(path: str, sheet: str, rows: Iterator, zone: str, file: tuple[int, str]) -> Iterator[pa.RecordBatch]:
    first_number, first, _ = next(rows, (None, None, None))
    if first is None:
        return
    names, seen = header_names(first), ColumnMasks(zone)
    layout = _digest(names)
    for block in _blocks(rows):
        seen.add([(cells, kinds) for _, cells, kinds in block])
        yield _cells_batch(path, sheet, layout, block)
    masks = seen.masks + [None] * (len(names) - len(seen.masks))
    names = names + [f"_c{i}" for i in range(len(names), len(masks))]
    yield _record_batch([(SUMMARY, path, sheet, first_number, layout, names, None, masks, None, *file)])


def _digest(names: list[str]) -> int:
    return int.from_bytes(blake2b(repr(names).encode(), digest_size=8).digest(), signed=True)


def _cells_batch(path: str, sheet: str, layout: int, block: list[tuple]) -> pa.RecordBatch:
    """The rows of cells of one block; what they share or lack is not spelt out for each."""
    n, numbers_and_cells = len(block), {"row_no": [b[0] for b in block], "cells": [b[1] for b in block]}
    shared = {"part": CELLS, "path": path, "sheet": sheet, "layout": layout}
    columns = [
        pa.array(numbers_and_cells[f.name], type=f.type) if f.name in numbers_and_cells else pa.repeat(pa.scalar(shared.get(f.name), f.type), n)
        for f in _ARROW_SCHEMA
    ]
    return pa.RecordBatch.from_arrays(columns, schema=_ARROW_SCHEMA)


def _record_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(values, type=f.type) for values, f in zip(zip(*rows), _ARROW_SCHEMA)]
    return pa.RecordBatch.from_arrays(columns, schema=_ARROW_SCHEMA)


def stage_sheets(workbooks: DataFrame, sheets: Sequence[str], path: str | None = None) -> DataFrame:
    """Parse once, keep the rows in the shared folder: one directory per sheet, cells and
    summaries apart."""
    path = path or fresh_path(workbooks.sparkSession, "sheets")
    return stage(scan_sheets(workbooks, sheets), path, partition_by=("sheet", "part"))


def sheet_frame(rows: DataFrame, sheet: str, infer: bool = True) -> DataFrame:
    """One sheet of scanned rows: header row to column names, cells to types by their
    kind. Names and types come from the summaries; cells are read once, by the caller.

    Columns are matched by name across workbooks, whatever the case; the spelling that
    stands furthest left wins. A column that a workbook lacks is null for its rows.
    Cells beyond a header are kept under ``_c<position>``. A sheet that could not be
    read in some workbook raises ``ValueError`` with the causes.
    """
    summaries = sheet_summaries(rows, sheet)
    columns, layouts, broken = _columns(summaries)
    if broken:
        causes = summaries.where(F.col("error").isNotNull()).select("path", "error")
        told = "; ".join(f"{row['path']}: {row['error']}" for row in causes.orderBy("path").take(_NAMED_CAUSES))
        more = f"; and {broken - _NAMED_CAUSES} more" if broken > _NAMED_CAUSES else ""
        raise ValueError(f"cannot read sheet {sheet!r} of {told}{more}")
    if not columns:
        raise ValueError(f"no workbook has a sheet {sheet!r} with a header row")
    places = _places(summaries, [*columns])
    # one header heads most rows: a shuffle by it would bring them to one task
    places = F.broadcast(places) if layouts * len(columns) <= _SENT_POSITIONS else places.hint("rebalance")
    text = _cells_by_name(_of_sheet(rows, sheet, CELLS), places, [*columns])
    return apply_types(text, {name: narrowest(mask) for name, mask in columns.items()}) if infer else text


def sheet_summaries(rows: DataFrame, sheet: str) -> DataFrame:
    """One row per workbook with the sheet: path, length, digest; header or error."""
    return _of_sheet(rows, sheet, SUMMARY)


def _of_sheet(rows: DataFrame, sheet: str, part: str) -> DataFrame:
    return rows.where((F.col("sheet") == sheet) & (F.col("part") == part))


def _columns(summaries: DataFrame) -> tuple[dict[str, int | None], int, int]:
    """Every header name once, by leftmost position, with the types that hold its values
    in all workbooks: as many rows as columns. The most that distinct headers can be, give
    or take an estimate's error, and the number of errors."""
    named = summaries.select("error", "layout", F.posexplode_outer(F.arrays_zip(F.col("header").alias("name"), F.col("masks").alias("mask"))))
    leftmost = F.min(F.struct("pos", "col.name")).alias("first")
    layouts = F.approx_count_distinct("layout").alias("layouts")
    found = named.groupBy(F.lower("col.name").alias("folded")).agg(leftmost, F.bit_and("col.mask").alias("mask"), layouts, F.count("error").alias("errors"))
    rows = found.select("first.*", "mask", "layouts", "errors").orderBy("pos", "name").collect()
    columns = {row["name"]: row["mask"] for row in rows if row["name"] is not None}
    return columns, sum(row["layouts"] for row in rows), sum(row["errors"] for row in rows)


def _places(summaries: DataFrame, names: list[str]) -> DataFrame:
    """Where each layout has the names, worked out once, on its widest header."""
    widest = summaries.groupBy("layout").agg(F.max_by("header", F.size("header")).alias("header"))
    folded = F.transform("header", F.lower)
    at = [F.array_position(folded, F.lit(n.lower())).cast("int") - 1 for n in names]
    return widest.select("layout", F.array(*at).alias("places"))


def _cells_by_name(body: DataFrame, places: DataFrame, names: list[str]) -> DataFrame:
    """Cells picked by where their row's header has the name.

    Places that are not broadcast are rebalanced: AQE splits the rows of a hot header
    only if the other side of the join is no aggregate on its key."""
    cells = [F.get("cells", F.get("places", F.lit(i))).alias(name) for i, name in enumerate(names)]
    return body.select("layout", "cells").join(places, "layout").select(*cells)


@contextmanager
def read_sheet(spark: SparkSession, path: str | list[str], sheet: str) -> Iterator[DataFrame]:
    """One named sheet of all workbooks under ``path``, for as long as the context lasts;
    the staged rows are removed at the end."""
    with sheet_sources(spark, path, [sheet]) as sources:
        yield sources[sheet]()


@contextmanager
def sheet_sources(
    spark: SparkSession, path: str | list[str], sheets: Sequence[str], sink: TableSink | None = None, ranged: bool = False
) -> Iterator[dict[str, Callable[[], DataFrame]]]:
    """A loader per sheet, for as long as the context lasts.

    The first loader called parses the workbooks for all, and the outcome, good or bad,
    is that of the others too; the staged rows are removed at the end. With a ``sink``
    workbooks in the ledger of the sheet's table are left out, and a table run adds those
    it loads; a sheet without a new workbook raises ``NothingNew``. ``ranged`` is for
    large workbooks, as ``open_workbooks`` has it.
    """
    parse = _Parse(spark, path, sheets, sink, ranged)
    try:
        yield {sheet: SheetSource(parse, sheet) for sheet in sheets}
    finally:
        remove_path(spark, parse.staged_path)


class SheetSource:
    """Loads one sheet."""

    def __init__(self, parse: _Parse, sheet: str):
        self._parse, self._sheet = parse, sheet

    def __call__(self) -> DataFrame:
        return sheet_frame(self._rows(), self._sheet)

    def files(self) -> DataFrame | None:
        """Path, length and digest of the workbooks the rows come from, for the ledger."""
        if self._parse.sink is None:
            return None
        return sheet_summaries(self._rows(), self._sheet).select(*LEDGER_COLUMNS)

    def _rows(self) -> DataFrame:
        return self._parse.rows_of(self._sheet)


class _Parse:
    """The one parse that the loaders of all sheets share, on whichever thread is first."""

    def __init__(self, spark: SparkSession, path: str | list[str], sheets: Sequence[str], sink: TableSink | None, ranged: bool):
        self._spark, self._path, self._sheets, self.sink, self._ranged = spark, path, list(sheets), sink, ranged
        self.staged_path = fresh_path(spark, "sheets")
        self._outcome: DataFrame | Exception | None = None
        self._new: dict[str, list[str]] = {}
        self._lock = Lock()

    def rows_of(self, sheet: str) -> DataFrame:
        with self._lock:
            if self._outcome is None:
                try:
                    self._outcome = stage_sheets(self._workbooks(), self._sheets, self.staged_path)
                except Exception as cause:
                    self._outcome = cause
        if isinstance(self._outcome, Exception):
            raise self._outcome
        if self.sink is None:
            return self._outcome
        if not self._new[sheet]:
            raise NothingNew(sheet)
        if all(paths == self._new[sheet] for paths in self._new.values()):
            return self._outcome
        own = self._spark.createDataFrame([(path,) for path in self._new[sheet]], "path string")
        return self._outcome.join(own, "path", "left_semi")

    def _workbooks(self) -> DataFrame:
        if self.sink is None:
            return open_workbooks(self._spark, self._path, self._ranged)
        tables = {sheet: f"{sheet}{LOADS_SUFFIX}" for sheet in self._sheets}
        known = {s: self._spark.table(self.sink.name(t)) if self.sink.exists(t) else None for s, t in tables.items()}
        # file names, which the driver lists in any case
        found = new_files(self._spark, self._path, known).collect()
        self._new = {sheet: sorted(r["path"] for r in found if r["sheet"] == sheet) for sheet in self._sheets}
        paths = sorted({r["path"] for r in found})
        if not paths:
            raise NothingNew(", ".join(self._sheets))
        return open_workbooks(self._spark, [as_pattern(p) for p in paths], self._ranged)
