"""Left outer equi-joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, types as T

from tablekit.functions.casts import tolerant_cast


def left_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left outer join on one key, keeping the left side's key column.

    No broadcast hint: Spark broadcasts a side whose size it has measured to be
    small, and otherwise sort-merges, where AQE splits partitions of hot keys.
    """
    left_type, right_type = left.schema[key].dataType, right.schema[key].dataType
    right = right.withColumnRenamed(key, "__key")
    on = _as_key(left[key], left_type, right_type) == _as_key(right["__key"], right_type, left_type)
    return left.join(right, on, "left").drop("__key")


def _as_key(column: Column, own: T.DataType, other: T.DataType) -> Column:
    """A text key meets a number as a number; text that is none matches nothing."""
    if isinstance(own, T.StringType) and isinstance(other, T.NumericType):
        return tolerant_cast(column, own, other)
    return column


def is_broadcastable(df: DataFrame) -> bool:
    """Whether Spark's size estimate of ``df`` is within its broadcast threshold.

    Only join order depends on the answer; the join itself stays Spark's choice.
    """
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(size)) <= limit
