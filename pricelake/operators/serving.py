"""Batch rows to keyed serving rows, and the key/cell form of those rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelake.functions import day_key, epoch_seconds, minute_key
from pricelake.operators.batch import expand_time
from pricelake.schemas import CELL_PREFIX, DAILY_COLUMNS, FULL_COLUMNS

# Newest-first order of a row, by mode. Nulls sort lowest: a row from the batch
# build has no arrival, so any streamed row replaces it in arrival mode.
ORDERS = {
    "event_time": ["event_time", "seq"],
    "arrival": ["arrived_at", "batch", "seq"],
}


def closing_rows(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """The last row of each key, whole.

    Catalyst turns ``row_number() = 1`` into a group limit on both sides of the
    exchange: each task sends at most one row per key, however hot the key is.
    """
    newest = [F.desc(name) for name in [*order_by, *tiebreak]]
    window = Window.partitionBy(*keys).orderBy(*newest)
    return (
        df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") == 1).drop("_rank")
    )


def _present(df: DataFrame, names: Sequence[str]) -> list[str]:
    return [name for name in names if name in df.columns]


def latest_seconds(batch: DataFrame) -> DataFrame:
    """The newest batch row of each pair and second, without its time texts.

    ``_second`` stands for the day and time of day: a number is cheaper to sort
    by and to send than the texts, which ``with_texts`` derives again.
    """
    texts = ["price_date", "price_time", "full_timestamp"]
    rows = batch.drop(*texts).withColumn("_second", epoch_seconds(F.col("time_ms")))
    keyed = rows.where(F.col("pair").isNotNull() & F.col("_second").isNotNull())
    tiebreak = _present(
        batch, ["event_time", "seq", "close", "volume", "open", "high", "low"]
    )
    return closing_rows(keyed, ["pair", "_second"], ["time_ms"], tiebreak)


def with_texts(seconds: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Minute serving rows (and the columns to ``keep``) from ``latest_seconds``."""
    timed = expand_time(seconds.withColumnRenamed("time_ms", "time"))
    key = minute_key(F.col("pair"), F.col("price_date"), F.col("price_time"))
    return timed.withColumn("pair_date_time", key).select(*FULL_COLUMNS, *keep)


def build_full(batch: DataFrame) -> DataFrame:
    """Minute serving rows: one per pair and second, the newest where keys meet."""
    return with_texts(latest_seconds(batch))


def build_daily(batch: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Daily serving rows: the closing row of each pair and day.

    ``volume`` is that last row's volume, not the day's total. ``keep`` names
    order columns to carry along for the serving store.
    """
    keyed = batch.where(F.col("pair").isNotNull() & F.col("price_date").isNotNull())
    tiebreak = _present(batch, ["event_time", "seq", "close", "volume"])
    rows = closing_rows(keyed, ["pair", "price_date"], ["time_ms"], tiebreak)
    return with_day_key(rows).select(*DAILY_COLUMNS, *keep)


def with_day_key(df: DataFrame) -> DataFrame:
    return df.withColumn("pair_date", day_key(F.col("pair"), F.col("price_date")))


def _order_struct(df: DataFrame, order: str, keys: Sequence[str]) -> Column:
    """The mode's order, then the remaining columns so that picks are total."""
    if order not in ORDERS:
        raise ValueError(f"unknown order {order!r}")
    first = _present(df, ORDERS[order])
    rest = [name for name in df.columns if name not in first and name not in keys]
    return F.struct(*first, *rest)


def latest_by_key(df: DataFrame, keys: Sequence[str], order: str = "event_time") -> DataFrame:
    """One row per key, last write wins.

    ``max`` of a struct that starts with the order columns: partial aggregation
    sends one row per key and task, and the answer does not depend on the order
    in which rows arrive.
    """
    newest = F.max(_order_struct(df, order, keys)).alias("_row")
    return df.groupBy(*keys).agg(newest).select(*keys, "_row.*").select(*df.columns)


def latest_by_either_order(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """At most two rows per key: the last by event time and the last to arrive.

    Reducing a log this way leaves both merge orders exact.
    """
    columns = [name for name in df.columns if name not in keys]
    whole = F.struct(*columns)
    picks = [F.max_by(whole, _order_struct(df, order, keys)) for order in ORDERS]
    return (
        df.groupBy(*keys)
        .agg(F.array_distinct(F.array(*picks)).alias("_rows"))
        .select(*keys, F.inline("_rows"))
        .select(*df.columns)
    )


def to_cells(
    df: DataFrame, key: str, columns: Sequence[str], version: str | None = None
) -> DataFrame:
    """Wide rows to (key, column, value[, version]); a null is no cell."""
    kept = [key] + ([version] if version else [])
    texts = df.select(
        *kept, *[F.col(name).cast("string").alias(CELL_PREFIX + name) for name in columns]
    )
    cells = texts.unpivot(
        kept, [F.col(f"`{CELL_PREFIX}{name}`") for name in columns], "column", "value"
    )
    return cells.where(F.col("value").isNotNull())


def from_cells(
    cells: DataFrame, columns: Sequence[str], key: str = "key", version: str = "version"
) -> DataFrame:
    """Cells to wide rows, the newest version of each cell; a missing cell is null.

    One conditional aggregate per column instead of ``pivot``, which would
    aggregate (and shuffle) twice: by key and column, then by key.
    """
    name = F.regexp_replace("column", f"^{CELL_PREFIX}", "")
    newest = F.struct(version, "value")
    return (
        cells.withColumn("_name", name)
        .groupBy(key)
        .agg(
            *[
                F.max(F.when(F.col("_name") == column, newest))["value"].alias(column)
                for column in columns
            ]
        )
    )
