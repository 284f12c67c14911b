"""Operators on DataFrames: normalisation, rules, union, date partitions."""

from tablekit.operators.combine import combine_frames
from tablekit.operators.joins import is_broadcastable, left_join
from tablekit.operators.normalize import (
    drop_null_columns,
    normalize,
    null_tokens,
    strip_headers,
    trim_strings,
)
from tablekit.operators.partitions import date_partition
from tablekit.operators.rules import ERROR_COLUMN, Rule, Split, apply_rules

__all__ = [
    "ERROR_COLUMN",
    "Rule",
    "Split",
    "apply_rules",
    "combine_frames",
    "date_partition",
    "drop_null_columns",
    "is_broadcastable",
    "left_join",
    "normalize",
    "null_tokens",
    "strip_headers",
    "trim_strings",
]
