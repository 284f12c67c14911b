"""Column expressions shared by the operators."""

from tablekit.functions.casts import cast_is_defined, tolerant_cast
from tablekit.functions.columns import quoted, string_columns

__all__ = ["cast_is_defined", "quoted", "string_columns", "tolerant_cast"]
