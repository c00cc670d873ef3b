"""Registered queries of running streams: keyed boards, expiry, the queue, paced triggers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.operators import parse_feed, ticker_only
from pricelake.plans import compact, current_view, expire
from pricelake.plans.given import ALL_AVAILABLE, deliver, feed_messages, quarters, replay, ticks
from pricelake.schemas import DAILY_COLUMNS
from pricelake.session import scratch_dir
from pricelake.streaming import (
    arrival_board_stream,
    board_rows,
    drain,
    fold_arrival_board,
    parse_ticks,
    read_arrival_board,
    read_ticks,
    split_valid,
    start_latest_state,
    start_upsert,
    to_messages,
    write_ticks,
)

FILES_A_BATCH = 2


def view(spark: SparkSession, root: str, order: str = "event_time") -> DataFrame:
    return current_view(spark, root, order).select(*DAILY_COLUMNS, "volume_kind", "seq")


def board_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The live view after four deliveries out of order, each after a restart.

    The changes of the first three are folded between two of them.
    """
    path = scratch_dir(spark, "arrivals")
    feed = feed_messages(spark, sf_dir)
    at = F.get_json_object("value", "$.time").cast("timestamp")
    quarter = F.floor(F.hour(at) / 6) + 1

    def start(stream: DataFrame, checkpoint: str):
        if checkpoint in started:
            fold_arrival_board(spark, path)
        started.add(checkpoint)
        rows = board_rows(ticker_only(parse_feed(stream)))
        return arrival_board_stream(rows, path, checkpoint, trigger=ALL_AVAILABLE)

    started: set[str] = set()
    deliver(spark, [feed.where(quarter == number) for number in (2, 4, 1, 3)], start)
    board = read_arrival_board(spark, path)
    return board.withColumns({name: F.col(name).cast("double") for name in ("price", "last_size")})


def stream_expired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compaction and expiry between deliveries of one stream and after them change nothing."""
    root = scratch_dir(spark, "store")
    for delivery in quarters(spark, sf_dir, (4, 2, 3, 1)):
        replay(spark, [delivery], root)
        compact(spark, root)
        expire(spark, root)
    return view(spark, root, "arrival")


def queue_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks published to the queue's stand-in and consumed from it, both restarted in between."""
    queue, root = scratch_dir(spark, "queue"), scratch_dir(spark, "store")
    consumed = scratch_dir(spark, "consumed")

    def publish(stream: DataFrame, checkpoint: str):
        valid = parse_ticks(stream).where("reason IS NULL")
        columns = ("pair", "price_date", "close", "volume", "event_time", "seq")
        publisher = write_ticks(
            valid.select(*columns), "parquet", {"path": queue}, checkpoint, ALL_AVAILABLE
        )
        publisher.awaitTermination()
        messages = read_ticks(spark, "parquet", path=queue)
        return start_upsert(parse_ticks(messages), root, consumed, ALL_AVAILABLE)

    deliver(spark, quarters(spark, sf_dir, (2, 1, 4, 3)), publish)
    return view(spark, root, "arrival")


def stream_paced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A backlog of files read two at a time under a timed trigger, stopped and started again."""
    inbox, root = scratch_dir(spark, "inbox"), scratch_dir(spark, "store")
    checkpoint = scratch_dir(spark, "checkpoint")
    rows = to_messages(ticks(spark, sf_dir).drop("time_ms")).select("value", "key")
    for part in (rows.where("key < 'm'"), rows.where("key >= 'm'")):
        part.select("value").repartition(5).write.mode("append").text(inbox)
        pace = {"maxFilesPerTrigger": str(FILES_A_BATCH)}
        messages = read_ticks(spark, "text", pace, inbox)
        timed = start_upsert(
            parse_ticks(messages), root, checkpoint, {"processingTime": "100 milliseconds"}
        )
        drain(timed)
    return view(spark, root)


def stream_latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest tick of each pair and day kept in state over four deliveries and restarts."""
    root = scratch_dir(spark, "store")

    def start(stream: DataFrame, checkpoint: str):
        valid, _ = split_valid(parse_ticks(stream))
        return start_latest_state(valid, root, checkpoint, ALL_AVAILABLE)

    deliver(spark, quarters(spark, sf_dir, (3, 1, 4, 2)), start)
    return view(spark, root)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "board_arrival": board_arrival,
    "stream_expired": stream_expired,
    "queue_round_trip": queue_round_trip,
    "stream_paced": stream_paced,
    "stream_latest_state": stream_latest_state,
}
