"""Queries over the test tables, and SQL for another engine to check them with."""
