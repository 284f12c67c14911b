"""Casts that give null for text that does not fit, whatever the ANSI setting."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tablekit.functions.columns import quoted

# Whole numbers may carry a decimal part, which is cut off: '2006.7' is 2006.
# The pattern also keeps plain words away from try_cast, whose failures to an
# integer type are caught exceptions and cost about 20 microseconds each.
DECIMAL_TEXT = r"^\s*[+-]?\d+(\.\d*)?\s*$"

_WHOLE_TYPES = (T.IntegerType, T.LongType)


def tolerant_cast(column: Column, source: T.DataType, target: T.DataType) -> Column:
    """``column`` as ``target``, null where the value does not fit."""
    if source == target:
        return column
    if isinstance(source, T.StringType) and isinstance(target, _WHOLE_TYPES):
        whole_part = F.substring_index(column, ".", 1)
        return F.when(column.rlike(DECIMAL_TEXT), whole_part.try_cast(target))
    return column.try_cast(target)


def cast_is_defined(df: DataFrame, name: str, target: T.DataType) -> bool:
    """Whether Spark knows a cast between the two types at all."""
    if isinstance(df.schema[name].dataType, T.StringType) and isinstance(target, T.AtomicType):
        return True
    try:
        df.select(quoted(name).try_cast(target)).schema
    except AnalysisException:
        return False
    return True
