"""Feed messages to ticks: parse, filter, project for the two consumers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from pricelake.functions import display_time, json_fields, pair_from_product, parse_time
from pricelake.schemas import FEED, ROLLING_24H

TICKER = "ticker"  # the one message type that carries prices (fixed value)


def parse_feed(messages: DataFrame, value: str = "value", corrupt: str | None = None) -> DataFrame:
    """One column per feed field; a message that is no JSON object is all null.

    With ``corrupt`` a column of that name holds the text of such a message.
    """
    others = [name for name in messages.columns if name != value]
    schema = StructType([*FEED.fields, StructField(corrupt, StringType())]) if corrupt else FEED
    return messages.select(*others, json_fields(value, schema, corrupt))


def ticker_only(feed: DataFrame) -> DataFrame:
    return feed.where(F.col("type") == TICKER)


def select_products(feed: DataFrame, products: Iterable[str] | DataFrame) -> DataFrame:
    """Keep the listed product ids; a list held in a table is semi-joined."""
    if isinstance(products, DataFrame):
        return feed.join(products.select("product_id"), "product_id", "left_semi").select(
            *feed.columns
        )
    return feed.where(F.col("product_id").isin(list(products)))


def to_backend(feed: DataFrame) -> DataFrame:
    """Queue projection. Prices stay the feed's own text until they are parsed."""
    event_time = parse_time(F.col("time"))
    return feed.select(
        pair_from_product(F.col("product_id")).alias("pair"),
        F.to_date(event_time).alias("price_date"),
        event_time.alias("event_time"),
        F.col("sequence").alias("seq"),
        F.col("price").alias("close"),
        F.col("volume_24h").alias("volume"),
        F.lit(ROLLING_24H).alias("volume_kind"),
    )


def to_frontend(feed: DataFrame) -> DataFrame:
    """Live-view projection: raw product id, readable time, size of last trade."""
    return feed.select(
        F.col("product_id").alias("pair"),
        display_time(parse_time(F.col("time"))).alias("price_date"),
        F.col("price").alias("close"),
        F.col("last_size").alias("volume"),
    )
