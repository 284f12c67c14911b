"""Catalog tables as DataFrames and SQL views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablekit.functions.columns import quote


def load_table(
    spark: SparkSession, database: str, table: str, view: str | None = None
) -> DataFrame:
    """Scan a catalog table and register it as a view, replacing an older one."""
    df = spark.table(f"{quote(database)}.{quote(table)}")
    df.createOrReplaceTempView(quote(view or table))
    return df


def run_query(spark: SparkSession, text: str) -> DataFrame:
    """Run SQL text over the registered views."""
    return spark.sql(text)
