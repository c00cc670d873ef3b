"""Batch operators on DataFrames."""

from pricelake.operators.batch import combine, drop_header_rows, expand_time
from pricelake.operators.catalog import pairs, pairs_from_files
from pricelake.operators.latest import latest_n
from pricelake.operators.lookup import format_row, key_range_scan, price_history
from pricelake.operators.normalize import (
    parse_feed,
    select_products,
    ticker_only,
    to_backend,
    to_frontend,
)
from pricelake.operators.serving import (
    build_daily,
    build_full,
    closing_rows,
    from_cells,
    latest_by_either_order,
    latest_by_key,
    to_cells,
    with_day_key,
)

__all__ = [
    "build_daily",
    "build_full",
    "closing_rows",
    "combine",
    "drop_header_rows",
    "expand_time",
    "format_row",
    "from_cells",
    "key_range_scan",
    "latest_by_either_order",
    "latest_by_key",
    "latest_n",
    "pairs",
    "pairs_from_files",
    "parse_feed",
    "price_history",
    "select_products",
    "ticker_only",
    "to_backend",
    "to_cells",
    "to_frontend",
    "with_day_key",
]
