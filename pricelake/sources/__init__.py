"""Readers and writers of stored bars."""

from pricelake.sources.bars import (
    header_names,
    read_bar_files,
    read_combined,
    read_combined_lines,
    read_lake,
)
from pricelake.sources.layouts import footers_only, write_bucketed
from pricelake.sources.sinks import (
    audit_counts,
    export_csv,
    table_location,
    write_lake,
    write_table,
)

__all__ = [
    "audit_counts",
    "export_csv",
    "footers_only",
    "header_names",
    "read_bar_files",
    "read_combined",
    "read_combined_lines",
    "read_lake",
    "table_location",
    "write_bucketed",
    "write_lake",
    "write_table",
]
