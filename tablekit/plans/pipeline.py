"""The table run: load, clean and store many tables, each failing on its own."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from tablekit.operators.normalize import normalize
from tablekit.operators.partitions import date_partition
from tablekit.operators.rules import REJECTED, judge_rows
from tablekit.plans.specs import TableSpec, clean
from tablekit.sinks.tables import TableRun, TableSink
from tablekit.sources.ledger import LOADS_SUFFIX, NothingNew, files_of

REPORT_SCHEMA = (
    "table_name string, status string, n_valid bigint, n_rejected bigint, "
    "skipped_rules array<string>, failed_stage string, error string"
)

# Tables loaded at the same time. Spark shares its cores among their jobs; with FAIR
# scheduling each table is a pool of its own name.
SIDE_BY_SIDE = 4
_POOL = "spark.scheduler.pool"


@dataclass
class TableResult:
    """``status`` is ``ok``, ``empty`` (no column held a value, nothing written),
    ``current`` (every source file was loaded before) or ``failed``; then
    ``failed_stage`` says how far the table got."""

    table_name: str
    status: str = "ok"
    n_valid: int | None = None
    n_rejected: int | None = None
    skipped_rules: tuple[str, ...] = ()
    failed_stage: str | None = None
    error: str | None = None


@dataclass(frozen=True)
class RunReport:
    results: list[TableResult]

    def frame(self, spark: SparkSession) -> DataFrame:
        """One row per table of the run."""
        rows = [{**asdict(r), "skipped_rules": list(r.skipped_rules)} for r in self.results]
        return spark.createDataFrame(rows, REPORT_SCHEMA)


def run_pipeline(
    specs: Iterable[TableSpec],
    sources: Mapping[str, Callable[[], DataFrame]],
    sink: TableSink,
    mode: str = "append",
    name: str | None = None,
    side_by_side: int = SIDE_BY_SIDE,
) -> RunReport:
    """Run every spec, several at a time; an error ends its table, not the run.

    The report keeps the order of the specs. A table and its errors are published
    together: a run that fails or is killed leaves neither half nor twice of it. A run
    with a ``name`` that is started again after that skips the tables it had published;
    without one every run adds its rows. ``overwrite`` leaves nothing of earlier runs,
    also where a load is empty or has no errors. ``overwrite_partitions`` adds to the
    error tables, which have no partitions.
    """

    def one(spec: TableSpec) -> TableResult:
        sink.spark.sparkContext.setLocalProperty(_POOL, spec.name)
        return _run_table(spec, sources, sink, mode, name and f"{name}.{spec.name}")

    with ThreadPoolExecutor(max(1, side_by_side)) as pool:
        return RunReport(list(pool.map(inheritable_thread_target(sink.spark)(one), list(specs))))


def _run_table(
    spec: TableSpec, sources: Mapping[str, Callable[[], DataFrame]], sink: TableSink, mode: str, name: str | None
) -> TableResult:
    result = TableResult(spec.name)
    stage = ["load"]
    try:
        if name and (done := sink.done(name)) is not None:
            return TableResult(**{**done, "skipped_rules": tuple(done["skipped_rules"])})
        source = sources[spec.name]
        df = source()
        loads = files_of(source)
        tables = [spec.name, f"{spec.name}_errors", f"{spec.name}{LOADS_SUFFIX}"]
        with sink.run(tables, name) as run:
            _store(spec, df, run, mode, result, stage)
            if loads is not None:
                stage.append("write_loads")
                run.write(loads, tables[2], mode="overwrite" if mode == "overwrite" else "append")
            run.notes.update(asdict(result))
            stage.append("publish")
    except NothingNew:
        result.status = "current"
    except Exception as error:
        result = TableResult(spec.name, "failed", skipped_rules=result.skipped_rules, failed_stage=stage[-1], error=f"{type(error).__name__}: {error}")
    return result


def _store(spec: TableSpec, df: DataFrame, run: TableRun, mode: str, result: TableResult, stage: list[str]) -> None:
    """Clean ``df`` and write its valid and its rejected rows."""
    stage.append("clean")
    errors = f"{spec.name}_errors"
    judged = rejected = None
    if spec.transform is None and spec.rules:
        valid = normalize(df)
        judged, result.skipped_rules = judge_rows(valid, spec.rules)
    else:
        valid, rejected, result.skipped_rules = clean(df, spec)
    if mode == "overwrite" and judged is None and (rejected is None or not valid.columns):
        run.clear(errors)
    if not valid.columns:
        result.status = "empty"
        if mode == "overwrite":
            run.clear(spec.name)
        return
    stage.append("write_valid")
    rows, partition_by = date_partition(valid if judged is None else judged, spec.partition_by)
    if judged is not None:
        result.n_valid, result.n_rejected = run.write_sides(rows, REJECTED, spec.name, errors, partition_by, mode, spec.rebalance)
        return
    result.n_valid = run.write(rows, spec.name, partition_by, mode, spec.rebalance)
    if rejected is not None:
        stage.append("write_rejected")
        # errors have no partitions: those of partitions that are not written stay
        keep = "append" if mode == "overwrite_partitions" else mode
        result.n_rejected = run.write(rejected, errors, mode=keep)
