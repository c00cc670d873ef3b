"""Row keys of the serving tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricelake.schemas import SHARDS


def _joined(*parts: Column) -> Column:
    # concat, not concat_ws: a missing part has to make the whole key missing.
    pieces = [parts[0].cast("string")]
    for part in parts[1:]:
        pieces += [F.lit("_"), part.cast("string")]
    return F.concat(*pieces)


def shard_of(pair: Column) -> Column:
    """Number of the folder a pair's serving rows are in."""
    return F.pmod(F.xxhash64(pair), F.lit(SHARDS)).cast("int")


def day_key(pair: Column, price_date: Column) -> Column:
    """``pair_yyyy-MM-dd``; the same key for batch and streamed rows."""
    return _joined(pair, price_date)


def minute_key(pair: Column, price_date: Column, price_time: Column) -> Column:
    """``pair_yyyy-MM-dd_HH:mm:ss``."""
    return _joined(pair, price_date, price_time)
