"""The live board: the newest n ticks per pair, kept current by a stream.

The board is a mergeable summary: the newest n of (old board + new ticks) are
the newest n of everything seen. So the state is a small table, pairs times n
rows, and the merge is the batch operator ``latest_n``: JVM-side, and limited to
n rows per pair and task before the exchange, however hot a pair is.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pricelake.files import children, delete
from pricelake.operators.latest import BOARD_ROWS, NEWEST_FIRST, latest_n
from pricelake.streaming.runs import BatchFolders
from pricelake.streaming.ticks import DEFAULT_TRIGGER

_TICK = ["pair", "event_time", "seq", "close", "volume"]
BOARD = (
    "pair string, event_time timestamp, seq bigint, close double, volume double, rank int"
)



def merge_board(board: DataFrame | None, ticks: DataFrame, n: int = BOARD_ROWS) -> DataFrame:
    """The board after ``ticks``: rows ranked 1..n per pair, newest first."""
    rows = ticks.select(*_TICK)
    if board is not None:
        rows = rows.unionByName(board.select(*_TICK))
    return latest_n(rows, n)


def latest_n_stream(
    ticks: DataFrame,
    path: str,
    checkpoint: str,
    n: int = BOARD_ROWS,
    trigger: Mapping[str, object] = DEFAULT_TRIGGER,
) -> StreamingQuery:
    """Keep the board of a tick stream below ``path``, one folder per micro-batch.

    A batch reads the folder of the batch before it and replaces its own, so a
    retry gives the same board. The checkpoint and ``path`` belong together: a
    new checkpoint is refused where another one's boards are.
    """
    folders = BatchFolders(checkpoint)

    def write(batch_df: DataFrame, batch: int) -> None:
        spark = batch_df.sparkSession
        folder = folders.only(spark, path, batch)
        before = None
        if batch:
            before = spark.read.schema(BOARD).parquet(f"{path}/{folders.name(spark, batch - 1)}")
        merge_board(before, batch_df, n).write.mode("overwrite").parquet(f"{path}/{folder}")

    return (
        ticks.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def _batches(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(batch, folder) of every board, newest first."""
    found = [
        (int(name.removeprefix("batch=")), f"{path}/{run}/{name}")
        for run, _ in children(spark, path)
        if run.startswith("run=")
        for name, _ in children(spark, f"{path}/{run}")
        if name.startswith("batch=")
    ]
    return sorted(found, reverse=True)


def read_board(spark: SparkSession, path: str) -> DataFrame:
    """The current board.

    The newest folder may be half written. It holds a whole board and a board
    never shrinks, so each rank is taken from it or else from the one before.
    Other folders are not opened; ``expire_boards`` removes them.
    """
    newest = [folder for _, folder in _batches(spark, path)[:2]]
    if not newest:
        raise ValueError(f"there is no board at {path}")
    boards = (
        spark.read.schema(f"{BOARD}, batch bigint").option("basePath", path).parquet(*newest)
    )
    row = F.max(F.struct("batch", *NEWEST_FIRST)).alias("_row")
    return (
        boards.groupBy("pair", "rank").agg(row).select("pair", "rank", "_row.*").drop("batch")
    )


def expire_boards(spark: SparkSession, path: str, keep: int = 100) -> int:
    """Delete all boards but the newest ``keep`` (two at least); returns how many went.

    A reader opens the two that were newest when it began, so ``keep`` is the number
    of micro-batches that a read may take.
    """
    old = _batches(spark, path)[max(2, keep) :]
    for _, folder in old:
        delete(spark, folder)
    return len(old)
