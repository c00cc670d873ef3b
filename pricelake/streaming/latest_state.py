"""The newest tick of each pair and day as a streaming aggregate with bounded state.

The state of a pair is the newest tick, by event time, of each of its newest ``DAYS`` days.
A tick that does not beat it changes nothing, so the delta log gets a row only where the
answer changes: one that is replayed, or older than what was seen, costs nothing downstream.

When a pair has more days, the oldest one's state is dropped, as days close and do not
open again. No watermark does that, since what is later than a watermark is thrown away: a
tick of a day whose state went, or never was, goes to the log, where last write wins
decides. So eviction bounds the state by pairs times days and costs no tick.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from pricelake.plans.store import KEYS, delta_path
from pricelake.schemas import ROLLING_24H
from pricelake.streaming.keyed_board import ROCKSDB
from pricelake.streaming.runs import BatchFolders
from pricelake.streaming.ticks import DEFAULT_TRIGGER
from pricelake.streaming.upsert import replace_batch

cloudpickle.register_pickle_by_value(sys.modules[__name__])

DAYS = 3

# Times travel as microseconds: whole numbers that compare and survive pandas. The first four
# fields are the order.
_TICK = "event_us bigint, seq bigint, close double, volume double, arrived_us bigint"
_KEYED = f"pair string, price_date date, {_TICK}"
_NO_SEQ = -(1 << 62)  # a tick without sequence is older than one with


def _rows(frame: pd.DataFrame) -> Iterator[tuple]:
    whole = (frame[name].astype(int).tolist() for name in ("event_us", "seq"))
    prices = (frame[name].astype(float).tolist() for name in ("close", "volume"))
    return zip(*whole, *prices, frame["arrived_us"].astype(int).tolist(), strict=True)


def _newest_of_task() -> Callable:
    """The newest tick of each pair and day among those of one task."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        newest: dict[tuple, tuple] = {}
        for frame in frames:
            for pair, day, row in zip(frame["pair"], frame["price_date"], _rows(frame), strict=True):
                if (pair, day) not in newest or newest[pair, day][:4] < row[:4]:
                    newest[pair, day] = row
        rows = [(*key, *row) for key, row in newest.items()]
        yield pd.DataFrame(rows, columns=[x.split()[0] for x in _KEYED.split(", ")])

    return run


class NewestOfDays(StatefulProcessor):
    """Keeps the newest tick of each of a pair's newest days; gives out those that change."""

    def __init__(self, days: int) -> None:
        self.days = days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getListState("newest", f"price_date date, {_TICK}")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = {day: tuple(row) for day, *row in self.newest.get()}
        changed: dict = {}
        for frame in rows:
            for day, row in zip(frame["price_date"], _rows(frame), strict=True):
                best = changed.get(day) or held.get(day)
                if best is None or best[:4] < row[:4]:
                    changed[day] = row
        if changed:
            held.update(changed)
            kept = sorted(held, reverse=True)[: self.days]
            self.newest.put([(day, *held[day]) for day in kept])
        out = [(key[0], day, *row) for day, row in changed.items()]
        yield pd.DataFrame(out, columns=[x.split()[0] for x in _KEYED.split(", ")])

    def close(self) -> None:
        pass


def start_latest_state(
    valid: DataFrame,
    root: str,
    checkpoint: str,
    trigger: Mapping[str, object] = DEFAULT_TRIGGER,
    days: int = DAYS,
) -> StreamingQuery:
    """Append the valid ticks that change a pair's day to the delta log of the store at ``root``.

    For readers in event-time order; the log of ``start_upsert`` serves both orders. Each
    micro-batch replaces its own folder when it is retried. Ticks without event time are
    not taken, as they have no place in this order.
    """
    valid.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    folders = BatchFolders(checkpoint)

    def write(changes: DataFrame, batch: int) -> None:
        folder = folders.name(changes.sparkSession, batch)
        rows = changes.select(
            *KEYS,
            "close",
            "volume",
            F.lit(ROLLING_24H).alias("volume_kind"),
            F.timestamp_micros("event_us").alias("event_time"),
            F.when(F.col("seq") != _NO_SEQ, F.col("seq")).alias("seq"),
            F.timestamp_micros("arrived_us").alias("arrived_at"),
        )
        replace_batch(rows.hint("rebalance", "price_date"), f"{delta_path(root)}/{folder}", "price_date")

    keyed = valid.where(F.col("event_time").isNotNull()).select(
        *KEYS,
        F.unix_micros("event_time").alias("event_us"),
        F.coalesce("seq", F.lit(_NO_SEQ).cast("bigint")).alias("seq"),
        "close",
        "volume",
        F.unix_micros("arrived_at").alias("arrived_us"),
    )
    newest = (
        keyed.mapInPandas(_newest_of_task(), _KEYED)
        .groupBy("pair")
        .transformWithStateInPandas(
            statefulProcessor=NewestOfDays(days),
            outputStructType=_KEYED,
            outputMode="Update",
            timeMode="None",
        )
    )
    return (
        newest.writeStream.foreachBatch(write)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
