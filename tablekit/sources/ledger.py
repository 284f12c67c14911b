"""Which workbooks a table was loaded from, so that a re-run can leave them out.

The ledger of table ``t`` is the table ``t_loads``: path, length and SHA-256 digest of
every workbook whose rows were published, in the same step as the rows themselves.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

LOADS_SUFFIX = "_loads"
LEDGER_COLUMNS = ["path", "length", "digest"]
_GLOB_SIGNS = re.compile(r"([\\{}\[\]*?,])")


class NothingNew(Exception):
    """Every file of a source is in the ledger of its table."""


def files_of(source: Callable[[], DataFrame]) -> DataFrame | None:
    """What a source that keeps a ledger tells of its files, None for any other."""
    files = getattr(source, "files", None)
    return files() if files else None


def new_files(spark: SparkSession, path: str | list[str], ledgers: dict[str, DataFrame | None]) -> DataFrame:
    """(sheet, path) of every workbook whose content the sheet's ledger lacks. A workbook
    that changed, or lies at another path, is new. Contents are read for their digest and
    do not move; what is joined is one short row per file."""
    found = spark.read.format("binaryFile").load(path).select("path", "length", F.sha2("content", 256).alias("digest"))
    missing = [
        (found if ledger is None else found.join(ledger, LEDGER_COLUMNS, "left_anti")).select(F.lit(sheet).alias("sheet"), "path")
        for sheet, ledger in ledgers.items()
    ]
    out = missing[0]
    for more in missing[1:]:
        out = out.unionAll(more)
    return out


def as_pattern(path: str) -> str:
    """A path that stands for itself where patterns are allowed."""
    return _GLOB_SIGNS.sub(r"\\\1", path)
