"""What the footers of Parquet files tell of their columns, without reading a page."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, functions as F, types as T

from tablekit.functions.columns import quoted

# A session of its own reads through the newer Parquet source, which answers counts from
# footers; the caller's settings stay as they are.
_FROM_FOOTERS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


def footer_counts(df: DataFrame) -> dict[str, int]:
    """How many values that are not null each column holds, for a frame that is a scan of
    whole Parquet files and nothing else; none for any other frame.

    Columns of nested types, and those that partition the files, are left out, as is
    everything where a footer lacks its counts.
    """
    scan = _plain_scan(df)
    if scan is None:
        return {}
    paths, stored = scan
    fields = [f for f in df.schema.fields if f.name in stored and isinstance(f.dataType, T.AtomicType)]
    if not fields:
        return {}
    apart = df.sparkSession.newSession()
    for key, value in _FROM_FOOTERS.items():
        apart.conf.set(key, value)
    files = apart.read.schema(T.StructType(fields)).parquet(*paths)
    counts = files.agg(*[F.count(quoted(f.name)).alias(str(i)) for i, f in enumerate(fields)])
    if "PushedAggregation: [COUNT(" not in counts._jdf.queryExecution().executedPlan().toString():
        return {}
    try:
        found = counts.first()
    except PySparkException:
        return {}  # a file without statistics, or one that cannot be read: the data tells
    return {f.name: found[i] for i, f in enumerate(fields)}


def _plain_scan(df: DataFrame) -> tuple[list[str], set[str]] | None:
    """Paths and stored columns of a frame that is a scan of Parquet files only."""
    plan = df._jdf.queryExecution().optimizedPlan()
    if plan.getClass().getSimpleName() != "LogicalRelation":
        return None
    relation = plan.relation()
    if relation.getClass().getSimpleName() != "HadoopFsRelation":
        return None
    if "Parquet" not in relation.fileFormat().getClass().getSimpleName():
        return None
    if relation.location().getClass().getSimpleName() == "CatalogFileIndex":
        return None  # its partitions may lie anywhere
    roots = relation.location().rootPaths()
    return [roots.apply(i).toString() for i in range(roots.size())], set(relation.dataSchema().fieldNames())
