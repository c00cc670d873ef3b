"""Structured Streaming jobs."""

from pricelake.streaming.board import (
    expire_boards,
    latest_n_stream,
    merge_board,
    read_board,
)
from pricelake.streaming.keyed_board import (
    arrival_board_stream,
    board_rows,
    fold_arrival_board,
    read_arrival_board,
)
from pricelake.streaming.latest_state import start_latest_state
from pricelake.streaming.ticks import (
    drain,
    parse_ticks,
    read_ticks,
    split_valid,
    to_messages,
    write_ticks,
)
from pricelake.streaming.upsert import fan_out, parquet_batches, queue_batches, start_upsert

__all__ = [
    "arrival_board_stream",
    "board_rows",
    "drain",
    "expire_boards",
    "fan_out",
    "fold_arrival_board",
    "latest_n_stream",
    "merge_board",
    "parquet_batches",
    "parse_ticks",
    "queue_batches",
    "read_arrival_board",
    "read_board",
    "read_ticks",
    "split_valid",
    "start_latest_state",
    "start_upsert",
    "to_messages",
    "write_ticks",
]
