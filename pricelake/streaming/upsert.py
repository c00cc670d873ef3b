"""Streaming upsert into the serving store, and fan-out to several outputs."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pricelake.operators.serving import latest_by_either_order
from pricelake.plans.store import KEYS, delta_path, quarantine_path
from pricelake.streaming.runs import BatchFolders
from pricelake.streaming.ticks import DEFAULT_TRIGGER, split_valid, to_messages

# Writes one output's rows of a micro-batch; the text names the batch as a folder.
BatchWriter = Callable[[DataFrame, str], None]


def replace_batch(df: DataFrame, path: str, folders: str) -> None:
    """Write a micro-batch to its own folder, whatever an earlier attempt left there."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(folders)
        .parquet(path)
    )


def start_upsert(
    parsed: DataFrame,
    root: str,
    checkpoint: str,
    trigger: Mapping[str, object] = DEFAULT_TRIGGER,
    run: str | None = None,
) -> StreamingQuery:
    """Append the parsed ticks to the store's delta log and quarantine the rest.

    Each micro-batch owns its folder and replaces it when it is retried, so a
    lost executor or a restart adds nothing twice. Before writing, a batch is
    reduced to the ticks that can still win a merge: at most two per pair and
    day, whatever the tick rate. Folders are named by ``run``, which belongs to
    this checkpoint alone; by default a name is made and kept in the checkpoint.
    """
    folders = BatchFolders(checkpoint, run)

    def write(batch_df: DataFrame, batch: int) -> None:
        folder = folders.name(batch_df.sparkSession, batch)
        # Only a rejected record's text is needed again, so only that is cached.
        raw = F.when(F.col("reason").isNotNull(), F.col("raw"))
        batch_df = batch_df.withColumn("raw", raw).persist()
        try:
            valid, rejected = split_valid(batch_df)
            winners = latest_by_either_order(valid.withColumn("batch", F.lit(batch)), KEYS)
            # Most ticks are of today: a rebalance keeps a day's files few, and is
            # split where the day is too large for one task.
            by_day = winners.drop("batch").hint("rebalance", "price_date")
            replace_batch(by_day, f"{delta_path(root)}/{folder}", "price_date")
            # Foldered too: a batch without rejects then leaves no empty file.
            replace_batch(rejected, f"{quarantine_path(root)}/{folder}", "reason")
        finally:
            batch_df.unpersist()

    return (
        parsed.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def parquet_batches(path: str) -> BatchWriter:
    """A fan-out output that keeps each batch in a folder of its own.

    A retried batch replaces its folder.
    """

    def write(df: DataFrame, folder: str) -> None:
        df.write.mode("overwrite").parquet(f"{path}/{folder}")

    return write


def queue_batches(options: Mapping[str, str], format: str = "kafka") -> BatchWriter:
    """A fan-out output that publishes JSON messages keyed by pair.

    A retried batch is published again, which last write wins makes harmless.
    """

    def write(df: DataFrame, folder: str) -> None:
        to_messages(df).write.format(format).options(**options).save()

    return write


def fan_out(
    feed: DataFrame,
    outputs: Mapping[str, tuple[Callable[[DataFrame], DataFrame], BatchWriter]],
    checkpoint: str,
    trigger: Mapping[str, object] = DEFAULT_TRIGGER,
) -> StreamingQuery:
    """Send one feed to several outputs, each with its own projection.

    The source is read once per micro-batch, not once per output.
    """
    folders = BatchFolders(checkpoint)

    def write(batch_df: DataFrame, batch: int) -> None:
        folder = folders.name(batch_df.sparkSession, batch)
        batch_df = batch_df.persist()
        try:
            for project, write_batch in outputs.values():
                write_batch(project(batch_df), folder)
        finally:
            batch_df.unpersist()

    return (
        feed.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
