"""Naming helpers: safe references to arbitrary column names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


def quoted(name: str) -> Column:
    """Reference a column whose name may hold dots, spaces or backticks."""
    return F.col(quote(name))


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def string_columns(df: DataFrame) -> set[str]:
    return {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}


def fold_case(spark: SparkSession, name: str) -> str:
    """The spelling Spark compares column names by in this session."""
    if spark.conf.get("spark.sql.caseSensitive", "false") == "true":
        return name
    return name.lower()
