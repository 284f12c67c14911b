"""Header, text and null-marker clean-up, applied before any rule."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame, functions as F

from tablekit.functions.columns import fold_case, quoted, string_columns
from tablekit.operators.footers import footer_counts

NULL_TOKEN = "NULL"
PROBE_ROWS = 1000


def strip_headers(df: DataFrame) -> DataFrame:
    """Cut whitespace off both ends of every column name."""
    names = [name.strip() for name in df.columns]
    counts = Counter(fold_case(df.sparkSession, name) for name in names)
    clashes = [name for name in names if counts[fold_case(df.sparkSession, name)] > 1]
    if clashes:
        raise ValueError(f"column names are not unique once stripped: {clashes}")
    return df if names == df.columns else df.toDF(*names)


def trim_strings(df: DataFrame) -> DataFrame:
    """Cut spaces (only spaces) off both ends of every string value."""
    text = string_columns(df)
    return df.select(
        *[F.trim(quoted(c)).alias(c) if c in text else quoted(c) for c in df.columns]
    )


def null_tokens(df: DataFrame) -> DataFrame:
    """Turn the exact text ``NULL`` into a null in every string column."""
    text = string_columns(df)
    return df.select(
        *[
            F.nullif(quoted(c), F.lit(NULL_TOKEN)).alias(c) if c in text else quoted(c)
            for c in df.columns
        ]
    )


def drop_null_columns(df: DataFrame, source: DataFrame | None = None) -> DataFrame:
    """Drop every column that holds no value in any row.

    Where ``df`` is a scan of whole Parquet files, their footers settle it without
    reading any data. ``source`` is such a scan that ``df`` was made of, column by column
    and row by row: its footers settle columns without text, which stay as they are, and
    those without any value.

    For the others one value proves that a column stays, so a short probe settles most
    without a scan: ``take`` stops reading at the first files. What the probe leaves open
    is counted exactly, over all rows but only those columns.
    """
    counts = footer_counts(df if source is None else source)
    names = df.columns if source is None else source.columns
    text = set() if source is None else string_columns(df)
    known = {c: counts[name] for c, name in zip(df.columns, names) if name in counts and (c not in text or not counts[name])}
    empty = {c for c, n in known.items() if not n}
    unknown = [c for c in df.columns if c not in known]
    open_columns = _without_value_in_probe(df.select(*map(quoted, unknown))) if unknown else []
    if open_columns:
        found = df.agg(*[F.count(quoted(c)).alias(str(i)) for i, c in enumerate(open_columns)]).first()
        empty |= {c for c, n in zip(open_columns, found) if n == 0}
    return df.select(*[quoted(c) for c in df.columns if c not in empty]) if empty else df


def _without_value_in_probe(df: DataFrame) -> list[str]:
    flags = df.select(
        *[quoted(c).isNotNull().alias(str(i)) for i, c in enumerate(df.columns)]
    )
    rows = flags.take(PROBE_ROWS)
    return [c for i, c in enumerate(df.columns) if not any(row[i] for row in rows)]


def normalize(df: DataFrame) -> DataFrame:
    """All clean-up steps, in the order the rules expect."""
    return drop_null_columns(null_tokens(trim_strings(strip_headers(df))), source=df)
