"""Date columns to partition a table by."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, types as T

from tablekit.functions.columns import fold_case, quoted


def date_partition(df: DataFrame, fields: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Add ``<field>_partition`` (a date) for every timestamp field.

    Returns the frame and the columns to partition by. Other fields, and names
    the frame does not have, are passed on as they are. A frame that has a column of the
    new name already is refused: its values would be lost.
    """
    timestamps = {
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))
    }
    present = {fold_case(df.sparkSession, c) for c in df.columns}
    taken = [f"{f}_partition" for f in fields if f in timestamps and fold_case(df.sparkSession, f"{f}_partition") in present]
    if taken:
        raise ValueError(f"the input has the names of partition columns: {taken}")
    dates = {f"{f}_partition": quoted(f).cast("date") for f in fields if f in timestamps}
    partition_by = [f"{f}_partition" if f in timestamps else f for f in fields]
    return (df.withColumns(dates) if dates else df), partition_by
