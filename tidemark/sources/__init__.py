"""Where tables come from and go to."""

from tidemark.sources.generated import calendar_months, literal_table, months_between_bounds
from tidemark.sources.raw import (
    PROVENANCE,
    business_columns,
    encoding_report,
    file_listing,
    line_counts,
    load_completeness,
    missing_files,
    read_raw,
    require_files,
    with_provenance,
)
from tidemark.sources.tables import TableStore, temporary_store

__all__ = [
    "PROVENANCE",
    "TableStore",
    "business_columns",
    "calendar_months",
    "encoding_report",
    "file_listing",
    "line_counts",
    "literal_table",
    "load_completeness",
    "missing_files",
    "months_between_bounds",
    "read_raw",
    "require_files",
    "temporary_store",
    "with_provenance",
]
