"""Range lookups on serving rows."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.schemas import LOOKUP_COLUMNS

_ISO_DATE = re.compile(r"\d{4}-\d{2}-\d{2}")


def _iso_date(name: str, value: str | dt.date) -> dt.date:
    if isinstance(value, dt.date):
        return value
    if not _ISO_DATE.fullmatch(value):
        raise ValueError(f"{name} must be yyyy-MM-dd, not {value!r}")
    return dt.date.fromisoformat(value)


def price_history(
    df: DataFrame, pair: str, start: str | dt.date, end: str | dt.date
) -> DataFrame:
    """Rows of one pair between two dates, both included, oldest first.

    Typed predicates, so the pair prunes partition folders and the dates reach
    the Parquet scan. An unknown pair or ``start > end`` gives no rows.
    """
    for name, value in (("pair", pair), ("start", start), ("end", end)):
        if not value:
            raise ValueError(f"missing required parameter: {name}")
    first, last = _iso_date("start", start), _iso_date("end", end)
    return (
        df.where((F.col("pair") == pair) & F.col("price_date").between(F.lit(first), F.lit(last)))
        .select(*LOOKUP_COLUMNS)
        .orderBy("price_date")
    )


def key_range_scan(df: DataFrame, key: str, start: str, stop: str) -> DataFrame:
    """Rows with ``start <= key < stop`` in binary text order.

    Append ``\\x00`` to ``stop`` to include the stop key itself. This form
    prunes no partitions; use ``price_history`` where pair and dates are known.
    """
    return df.where((F.col(key) >= start) & (F.col(key) < stop)).orderBy(key)


def format_row(df: DataFrame) -> DataFrame:
    """Lookup rows as text, for display."""
    return df.select(*[F.col(name).cast("string").alias(name) for name in df.columns])
