"""What the registered queries are run on: the given tables as ticks, bars, messages and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.functions.times import ISO_MICROS
from pricelake.operators import build_daily
from pricelake.session import configure, scratch_dir
from pricelake.streaming import parse_ticks, read_ticks, start_upsert, to_messages

ALL_AVAILABLE = {"availableNow": True}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as ticks: pair, time, price, volume and a unique sequence."""
    at = F.col("ts").cast("timestamp")
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("pair"),
        F.unix_millis(at).alias("time_ms"),
        at.alias("event_time"),
        F.to_date(at).alias("price_date"),
        F.col("value").alias("close"),
        F.get_json_object("props", "$.k").cast("double").alias("volume"),
        F.col("event_id").alias("seq"),
    )


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks as combined seven-column bars (time still epoch milliseconds)."""
    return ticks(spark, sf_dir).select(
        "pair",
        F.col("time_ms").alias("time"),
        (F.col("close") + 1).alias("open"),
        "close",
        (F.col("close") + 2).alias("high"),
        (F.col("close") - 1).alias("low"),
        "volume",
        "seq",
    )


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_daily(ticks(spark, sf_dir))


def feed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live-feed JSON: errors are messages of another type."""
    kind = F.when(F.col("pair") == "error", "error").otherwise("ticker")
    message = F.struct(
        kind.alias("type"),
        F.concat(F.upper("pair"), F.lit("-USD-X")).alias("product_id"),
        F.col("seq").alias("sequence"),
        F.date_format("event_time", ISO_MICROS).alias("time"),
        F.col("close").cast("string").alias("price"),
        F.col("volume").cast("string").alias("volume_24h"),
        (F.col("volume") + 1).cast("string").alias("last_size"),
    )
    return ticks(spark, sf_dir).select(F.to_json(message).alias("value"))


def deliver(spark: SparkSession, deliveries: list[DataFrame], start) -> None:
    """Put each delivery into an inbox folder and run the stream on what is new.

    The stream stops after each delivery and resumes from its checkpoint.
    """
    inbox = scratch_dir(spark, "inbox")
    checkpoint = scratch_dir(spark, "checkpoint")
    for messages in deliveries:
        messages.select("value").write.mode("append").text(inbox)
        stream = read_ticks(spark, format="text", path=inbox)
        start(stream, checkpoint).awaitTermination()


def replay(spark: SparkSession, deliveries: list[DataFrame], root: str) -> None:
    deliver(
        spark,
        deliveries,
        lambda stream, checkpoint: start_upsert(
            parse_ticks(stream), root, checkpoint, ALL_AVAILABLE
        ),
    )


def quarters(spark: SparkSession, sf_dir: str, order: tuple[int, ...]) -> list[DataFrame]:
    """Messages by quarter of the day, in the given order of delivery.

    Every pair and day has ticks in each quarter, so the order matters.
    """
    quarter = F.floor(F.hour("event_time") / 6) + 1
    rows = ticks(spark, sf_dir).drop("time_ms")
    return [to_messages(rows.where(quarter == number)) for number in order]
