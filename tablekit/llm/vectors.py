"""Reading vector columns: which rows take part, and their numbers as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: str) -> Column:
    """True for a vector that is not null, has no null and no non-finite component, and
    is not zero throughout (an empty one is)."""
    v = F.col(f"`{vector}`")
    finite = F.forall(v, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    return F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def numbers(df: DataFrame, id: str, vector: str, *more: Column) -> DataFrame:
    """(id bigint, vector array<double>, ...) of the rows with an id and a usable vector."""
    v = F.col(f"`{vector}`").cast("array<double>").alias("vector")
    return df.where(usable(vector) & F.col(f"`{id}`").isNotNull()).select(F.col(f"`{id}`").cast("bigint").alias("id"), v, *more)


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of equal length as a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, without overflow on the way."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))
