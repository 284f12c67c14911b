"""Sinks: Parquet tables registered in the Spark catalog."""

from tablekit.sinks.tables import SchemaConflict, TableSink

__all__ = ["SchemaConflict", "TableSink"]
