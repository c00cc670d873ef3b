"""Whole builds and the serving store."""

from pricelake.plans.build import (
    batch_rows,
    build_batch,
    build_lake,
    daily_table,
    read_full,
    register_views,
    write_full,
)
from pricelake.plans.rejects import build_batch_with_rejects, read_accepted, read_rejects
from pricelake.plans.retention import expire
from pricelake.plans.store import (
    compact,
    current_view,
    read_base,
    read_delta,
    read_quarantine,
    stored_history,
    stored_key_range,
    write_base,
)

__all__ = [
    "batch_rows",
    "build_batch",
    "build_batch_with_rejects",
    "build_lake",
    "compact",
    "current_view",
    "daily_table",
    "expire",
    "read_accepted",
    "read_base",
    "read_delta",
    "read_full",
    "read_quarantine",
    "read_rejects",
    "register_views",
    "stored_history",
    "stored_key_range",
    "write_base",
    "write_full",
]
