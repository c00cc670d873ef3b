"""Bars to the batch table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from pricelake.functions import epoch_millis, epoch_seconds, pair_from_path
from pricelake.functions.times import TIME_IN_TIMESTAMP, TIMESTAMP_FORMAT
from pricelake.schemas import BATCH_A_COLUMNS, BATCH_B_COLUMNS, COMBINED_COLUMNS, CORRUPT

HEADER_PAIR = "pair"  # what a header row read as data holds in its first column


def combine(bars: DataFrame) -> DataFrame:
    """Raw bars with a ``path`` to the seven combined columns."""
    return bars.withColumn("pair", pair_from_path(F.col("path"))).select(*COMBINED_COLUMNS)


def drop_header_rows(df: DataFrame) -> DataFrame:
    """Remove header rows read as data; rows without a pair go with them."""
    return df.where(F.col("pair") != HEADER_PAIR)


REASONS = ("header row", "unreadable line", "missing pair", "missing time", "bad time")


def reject_reason() -> Column:
    """One of REASONS for a combined line that is no bar, else null.

    A time is bad if its text is no number or names no year from 1 to 9999.
    """
    header, unreadable, no_pair, no_time, bad_time = REASONS
    time = F.col("time")
    return (
        F.when(F.col("pair") == HEADER_PAIR, header)
        .when(F.col(CORRUPT).isNotNull(), unreadable)
        .when(F.coalesce(F.trim("pair"), F.lit("")) == "", no_pair)
        .when(F.coalesce(F.trim(time), F.lit("")) == "", no_time)
        .when(epoch_seconds(epoch_millis(time)).isNull(), bad_time)
    )


def expand_time(df: DataFrame, variant: str = "a") -> DataFrame:
    """Replace epoch-millisecond ``time`` by readable date and time columns.

    Variant "a" has ``price_date``, ``price_time`` and ``full_timestamp``;
    variant "b" has ``date`` and the full text as ``time``. Both add
    ``time_ms`` and keep every other column.
    """
    if variant not in ("a", "b"):
        raise ValueError(f"unknown variant {variant!r}")
    others = [name for name in df.columns if name != "time"]
    millis = F.col("time")
    if not isinstance(df.schema["time"].dataType, LongType):
        millis = epoch_millis(millis)
    timed = df.withColumn("time_ms", millis).withColumn(
        "_at", F.timestamp_seconds(epoch_seconds(F.col("time_ms")))
    )
    full = F.date_format("_at", TIMESTAMP_FORMAT)
    if variant == "a":
        layout = BATCH_A_COLUMNS
        derived = {
            "price_date": F.to_date("_at"),
            "price_time": F.substring(full, *TIME_IN_TIMESTAMP),
            "full_timestamp": full,
        }
    else:
        layout = BATCH_B_COLUMNS
        derived = {"date": F.to_date("_at"), "time": full}
    ordered = [name for name in layout if name in derived or name in others]
    extra = [name for name in others if name not in layout and name != "time_ms"]
    return timed.select(
        *[derived[name].alias(name) if name in derived else F.col(name) for name in ordered],
        "time_ms",
        *extra,
    )
