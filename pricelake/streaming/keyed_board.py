"""The live view's board: the newest arrivals of each product, as keyed state.

The view puts each tick on top as it arrives, whatever its event time says. So the state
of a product is the list of its newest n arrivals, kept by Spark in RocksDB beside the
checkpoint: it is bounded by products times n, spills to disk, and survives restarts and
lost executors. Each micro-batch gives the whole board of every product it touched.

This is the one plan of the library outside ``llm`` that runs Python: keyed state of this
kind has no built-in function. Each task first keeps its own newest n rows of a product,
so a product with a third of all ticks sends n rows a task to its state, not all of them.
"""

from __future__ import annotations

import heapq
import sys
from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from pricelake.files import children, delete
from pricelake.functions import display_time, parse_time
from pricelake.operators.latest import BOARD_ROWS
from pricelake.plans.build import is_complete
from pricelake.streaming.runs import BatchFolders
from pricelake.streaming.ticks import DEFAULT_TRIGGER

# Executors need no copy of this repository.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_SHOWN = ("sequence", "shown_at", "price", "last_size")
_ROW = "sequence bigint, shown_at string, price string, last_size string"
_ARRIVED = f"product_id string, {_ROW}"
_BOARD = f"product_id string, newest array<struct<{_ROW}>>"
_STORED = f"{_BOARD}, batch bigint"


def board_rows(feed: DataFrame) -> DataFrame:
    """Feed tickers as the view shows them: product, readable time, price, size of the last trade.

    Within a micro-batch the feed's own sequence tells which tick came later; a tick
    without one counts as earlier than all others.
    """
    return feed.where(F.col("product_id").isNotNull()).select(
        "product_id",
        F.coalesce("sequence", F.lit(-1).cast("bigint")).alias("sequence"),
        display_time(parse_time(F.col("time"))).alias("shown_at"),
        "price",
        "last_size",
    )


def _order(row: tuple) -> tuple:
    """Later arrivals are larger; texts make the order total."""
    return (int(row[0]), *(x or "" for x in row[1:]))


def _rows(frame: pd.DataFrame) -> Iterator[tuple]:
    """Rows of plain Python values."""
    texts = ([None if pd.isna(x) else x for x in frame[name]] for name in _SHOWN[1:])
    return zip(frame["sequence"].astype(int).tolist(), *texts, strict=True)


def _newest_of_task(n: int) -> Callable:
    """The newest n rows of each product among the rows of one task."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        newest: dict[str, list[tuple]] = {}
        for frame in frames:
            for product, row in zip(frame["product_id"], _rows(frame), strict=True):
                some = newest.setdefault(product, [])
                some.append(row)
                if len(some) >= 64 * n:
                    newest[product] = heapq.nlargest(n, some, _order)
        rows = [
            (product, *row)
            for product, some in newest.items()
            for row in heapq.nlargest(n, some, _order)
        ]
        yield pd.DataFrame(rows, columns=["product_id", *_SHOWN])

    return run


class NewestArrivals(StatefulProcessor):
    """The newest n arrivals of a product; what arrives later goes on top."""

    def __init__(self, n: int) -> None:
        self.n = n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getListState("newest", _ROW)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        arrived: list[tuple] = []
        for frame in rows:
            arrived = heapq.nlargest(self.n, [*arrived, *_rows(frame)], _order)
        board = [*arrived, *(tuple(row) for row in self.newest.get())][: self.n]
        self.newest.put(board)
        shown = [dict(zip(_SHOWN, row, strict=True)) for row in board]
        yield pd.DataFrame({"product_id": [key[0]], "newest": [shown]})

    def close(self) -> None:
        pass


def arrival_board_stream(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    n: int = BOARD_ROWS,
    trigger: Mapping[str, object] = DEFAULT_TRIGGER,
) -> StreamingQuery:
    """Keep the boards of ``board_rows`` below ``path``, one folder of changes per micro-batch.

    A retried micro-batch finds the state as it was before it and replaces its folder. The
    checkpoint and ``path`` belong together: a new checkpoint is refused where another
    one's boards are.
    """
    spark = rows.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    folders = BatchFolders(checkpoint)

    def write(changes: DataFrame, batch: int) -> None:
        folder = folders.only(changes.sparkSession, path, batch)
        changes.write.mode("overwrite").parquet(f"{path}/{folder}")

    boards = (
        rows.mapInPandas(_newest_of_task(n), _ARRIVED)
        .groupBy("product_id")
        .transformWithStateInPandas(
            statefulProcessor=NewestArrivals(n),
            outputStructType=_BOARD,
            outputMode="Update",
            timeMode="None",
        )
    )
    return (
        boards.writeStream.foreachBatch(write)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def _numbers(spark: SparkSession, path: str, prefix: str) -> list[int]:
    names = (name for name, _ in children(spark, path))
    return sorted(int(name.removeprefix(prefix)) for name in names if name.startswith(prefix))


def _folded(spark: SparkSession, path: str) -> list[int]:
    """The tables folded so far, by their last batch; one that broke off is none."""
    found = _numbers(spark, f"{path}/folded", "upto=")
    return [n for n in found if is_complete(spark, f"{path}/folded/upto={n}")]


def _newest_boards(spark: SparkSession, path: str, upto: int | None = None) -> DataFrame:
    """The newest board of each product: what was folded last, and the changes since."""
    done = _folded(spark, path)
    changes = spark.read.schema(_STORED).option("basePath", path).parquet(f"{path}/run=*")
    if done:
        folded = spark.read.schema(_STORED).parquet(f"{path}/folded/upto={done[-1]}")
        changes = folded.union(changes.where(F.col("batch") > done[-1]).select(*folded.columns))
    if upto is not None:
        changes = changes.where(F.col("batch") <= upto)
    return changes.groupBy("product_id").agg(
        F.max_by("newest", "batch").alias("newest"), F.max("batch").alias("batch")
    )


def read_arrival_board(spark: SparkSession, path: str) -> DataFrame:
    """(product_id, rank, sequence, shown_at, price, last_size), newest arrival first."""
    ranked = F.posexplode("newest").alias("place", "row")
    return (
        _newest_boards(spark, path)
        .select("product_id", ranked)
        .select("product_id", (F.col("place") + 1).alias("rank"), "row.*")
    )


def fold_arrival_board(spark: SparkSession, path: str) -> int:
    """Put all changes but the newest batch's into one table and delete them; returns the last one.

    The newest batch may still be written or retried. Of the tables folded before, the last
    one stays for readers that began with it.
    """
    runs = [name for name, _ in children(spark, path) if name.startswith("run=")]
    batches = {run: _numbers(spark, f"{path}/{run}", "batch=") for run in runs}
    last = max((b for some in batches.values() for b in some), default=0) - 1
    done = _folded(spark, path)
    if last < 0 or (done and done[-1] >= last):
        return done[-1] if done else -1
    boards = _newest_boards(spark, path, last).select("product_id", "newest", "batch")
    boards.write.mode("overwrite").parquet(f"{path}/folded/upto={last}")
    for run, some in batches.items():
        for batch in some:
            if batch <= (done[-1] if done else -1):
                delete(spark, f"{path}/{run}/batch={batch}")
    for upto in done[:-1]:
        delete(spark, f"{path}/folded/upto={upto}")
    return last
