"""Spark jobs that turn messy extracts into checked tables and wide models."""
