"""Column layouts of every stored table and message. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

PRICE_COLUMNS = ["open", "close", "high", "low", "volume"]
RAW_BAR_COLUMNS = ["time", *PRICE_COLUMNS]
COMBINED_COLUMNS = ["pair", *RAW_BAR_COLUMNS]
BATCH_A_COLUMNS = ["pair", "price_date", "price_time", "full_timestamp", *PRICE_COLUMNS]
BATCH_B_COLUMNS = ["pair", "date", "time", *PRICE_COLUMNS]
FULL_COLUMNS = ["pair_date_time", *BATCH_A_COLUMNS]
DAILY_COLUMNS = ["pair_date", "pair", "price_date", "close", "volume"]
LOOKUP_COLUMNS = ["pair", "price_date", "close", "volume"]

CORRUPT = "_corrupt"

# The prefix a cell's column name carries in the key/cell form (fixed value).
CELL_PREFIX = "cf:"

# How the four "volume" meanings are told apart (see README).
LAST_BAR = "last_bar"
ROLLING_24H = "rolling_24h"


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


_PRICES = {name: DoubleType() for name in PRICE_COLUMNS}

# One instrument per file: epoch milliseconds and prices, no instrument column.
RAW_BAR = _struct(time=LongType(), **_PRICES)

# Time stays text here so that a header row read as data is still recognisable.
COMBINED = _struct(pair=StringType(), time=StringType(), **_PRICES)

# Row of the batch table, as text.
BATCH = (
    "pair string, price_date date, price_time string, full_timestamp string, "
    + ", ".join(f"{name} double" for name in PRICE_COLUMNS)
    + ", time_ms bigint"
)

# The lake keeps the instrument as the partition folder.
LAKE = _struct(time=LongType(), **_PRICES, pair=StringType())

# Live feed message; only these fields are read, others are ignored.
FEED = _struct(
    type=StringType(),
    product_id=StringType(),
    sequence=LongType(),
    time=StringType(),
    price=StringType(),
    volume_24h=StringType(),
    last_size=StringType(),
)

# Queue payload: four text fields, plus the two order fields we add.
TICK_JSON = _struct(
    pair=StringType(),
    price_date=StringType(),
    close=StringType(),
    volume=StringType(),
    event_time=StringType(),
    seq=LongType(),
)

# Row of the daily serving table. ``arrived_at``/``batch`` are null for rows
# that came from the batch build.
SERVING = _struct(
    pair=StringType(),
    price_date=DateType(),
    close=DoubleType(),
    volume=DoubleType(),
    volume_kind=StringType(),
    event_time=TimestampType(),
    seq=LongType(),
    arrived_at=TimestampType(),
    batch=LongType(),
)

# A snapshot also stores its text key, by which it is sorted.
SNAPSHOT = StructType([*SERVING.fields, StructField("pair_date", StringType(), True)])

# Folder columns of both serving tables.
SHARD_FOLDERS = [StructField(name, IntegerType(), True) for name in ("shards", "shard")]

# Delta log: the serving row below run=/batch=/price_date= folders.
DELTA = StructType([*SERVING.fields, StructField("run", StringType(), True)])

# Rejected record below run=/batch=/reason= folders.
REJECTED = _struct(
    raw=StringType(),
    reason=StringType(),
    source_time=TimestampType(),
    run=StringType(),
    batch=LongType(),
)

# Row of the minute serving table.
FULL = _struct(
    pair_date_time=StringType(),
    pair=StringType(),
    price_date=DateType(),
    price_time=StringType(),
    full_timestamp=StringType(),
    **_PRICES,
)

# Serving tables are foldered by a hash of the pair: as many folders as this at
# most, however many pairs there are, and one of them per lookup.
SHARDS = 256

BAR_TIME_MIN_S = -62_135_596_800  # 0001-01-01T00:00:00Z
BAR_TIME_MAX_S = 253_402_300_799  # 9999-12-31T23:59:59Z
