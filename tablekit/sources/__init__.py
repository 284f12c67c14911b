"""Sources: sheets of workbooks and tables of the catalog."""

from tablekit.sources.catalog import load_table, run_query
from tablekit.sources.inference import apply_types, infer_types
from tablekit.sources.ledger import NothingNew
from tablekit.sources.sheets import (
    open_workbooks,
    read_sheet,
    scan_sheets,
    sheet_frame,
    sheet_sources,
    stage_sheets,
)

__all__ = [
    "NothingNew",
    "apply_types",
    "infer_types",
    "load_table",
    "open_workbooks",
    "read_sheet",
    "run_query",
    "scan_sheets",
    "sheet_frame",
    "sheet_sources",
    "stage_sheets",
]
