"""Ticks in and out of a queue: read, parse, validate, write."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pricelake.functions import json_fields, parse_time
from pricelake.functions.times import ISO_MICROS
from pricelake.schemas import ROLLING_24H, TICK_JSON

# The reference interval is 2 s; a longer one writes fewer, larger files.
DEFAULT_TRIGGER = {"processingTime": "30 seconds"}

MESSAGE = "key string, value string"
_PAYLOAD = ["pair", "price_date", "close", "volume"]  # the required fields


def read_ticks(
    spark: SparkSession,
    format: str = "kafka",
    options: Mapping[str, str] | None = None,
    path: str | None = None,
) -> DataFrame:
    """A stream of message texts with the order the source knows.

    Kafka gives the record's timestamp and offset. Its offsets order one pair's
    ticks only where the topic is keyed by pair, as ``write_ticks`` does. Files
    (format "text", one message per line) give their modification time, and so do
    the files that ``write_ticks`` publishes as "parquet": those are read by the
    sink's commit log, so what a broken-off batch left behind is not seen.
    ``maxFilesPerTrigger`` (files) and ``maxOffsetsPerTrigger`` (Kafka) pace a backlog.
    The first start begins at the latest offset, a restart at the checkpoint.
    """
    options = dict(options or {})
    if format == "kafka":
        options.setdefault("startingOffsets", "latest")
        records = spark.readStream.format("kafka").options(**options).load()
        return records.select(
            F.col("value").cast("string").alias("value"),
            F.col("timestamp").alias("source_time"),
            F.col("offset").alias("source_seq"),
        )
    reader = spark.readStream.format(format).options(**options)
    if format == "parquet":
        reader = reader.schema(MESSAGE)
    return reader.load(path).select(
        "value",
        F.col("_metadata.file_modification_time").alias("source_time"),
        F.lit(None).cast("bigint").alias("source_seq"),
    )


def parse_ticks(messages: DataFrame) -> DataFrame:
    """Typed tick columns and a ``reason`` that is null for a good record.

    Unknown payload fields are ignored. ``arrived_at`` is the micro-batch's own
    time, which a replay of the same batch sees again.
    """
    fields = messages.select(
        F.col("value").alias("raw"), "source_time", "source_seq", json_fields("value", TICK_JSON)
    )
    close = _finite(F.col("close"))
    volume = _finite(F.col("volume"))
    # Only the canonical text: the cast alone would also take "2024" or a time.
    day = F.col("price_date").try_cast("date")
    day = F.when(day.cast("string") == F.col("price_date"), day)
    return fields.select(
        "raw",
        "source_time",
        "pair",
        day.alias("price_date"),
        close.alias("close"),
        volume.alias("volume"),
        F.lit(ROLLING_24H).alias("volume_kind"),
        F.coalesce(parse_time(F.col("event_time")), "source_time").alias("event_time"),
        F.coalesce("seq", "source_seq").alias("seq"),
        F.current_timestamp().alias("arrived_at"),
        _reject_reason(day, close, volume).alias("reason"),
    )


def _finite(text: Column) -> Column:
    number = text.try_cast("double")
    return F.when(F.abs(number) < float("inf"), number)


def _reject_reason(day: Column, close: Column, volume: Column) -> Column:
    # A message that is no JSON object parses to a row without any field.
    reason = F.when(F.coalesce(*_PAYLOAD).isNull(), F.lit("malformed"))
    for name in _PAYLOAD:
        reason = reason.when(F.col(name).isNull(), F.lit(f"missing {name}"))
    return (
        reason.when(F.col("pair") == "", F.lit("missing pair"))
        .when(day.isNull(), F.lit("bad price_date"))
        .when(close.isNull(), F.lit("bad close"))
        .when(volume.isNull(), F.lit("bad volume"))
    )


def split_valid(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid ticks, rejected records with their raw text and reason)."""
    valid = parsed.where(F.col("reason").isNull()).drop("raw", "source_time", "reason")
    rejected = parsed.where(F.col("reason").isNotNull()).select("raw", "reason", "source_time")
    return valid, rejected


def to_messages(ticks: DataFrame, key: str = "pair") -> DataFrame:
    """Rows to (key, value) messages: the key orders one pair's ticks."""
    text = F.to_json(F.struct(*ticks.columns), {"timestampFormat": ISO_MICROS})
    return ticks.select(F.col(key).alias("key"), text.alias("value"))


def write_ticks(
    ticks: DataFrame,
    format: str,
    options: Mapping[str, str],
    checkpoint: str,
    trigger: Mapping[str, object] = DEFAULT_TRIGGER,
) -> StreamingQuery:
    """Publish a tick stream, one JSON message per tick.

    Kafka and "parquet" take key and value; a text sink has room for the value only.
    File sinks commit each micro-batch in a log, and readers of the folder go by it:
    each tick is published once, however often a batch is retried. Kafka may get a
    retried batch twice, which last write wins makes harmless.
    """
    messages = to_messages(ticks)
    if format == "text":
        messages = messages.select("value")
    return (
        messages.writeStream.format(format)
        .options(**options)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**trigger)
        .start()
    )


def drain(query: StreamingQuery) -> list[tuple[int, int]]:
    """Let a timed query read what there is, stop it, and tell its (batch, rows) so far.

    For queries under a processing-time trigger, which would otherwise run on. Spark
    keeps the progress of the newest hundred batches.
    """
    try:
        query.processAllAvailable()
        return [(p.batchId, p.numInputRows) for p in query.recentProgress]
    finally:
        query.stop()
