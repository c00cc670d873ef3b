"""The newest n ticks of each pair."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Price and volume make the order total where ticks share time and sequence.
NEWEST_FIRST = ("event_time", "seq", "close", "volume")
BOARD_ROWS = 9  # rows the live view shows per pair (fixed value)


def latest_n(
    df: DataFrame,
    n: int = BOARD_ROWS,
    key: str = "pair",
    order: Sequence[str] | None = None,
) -> DataFrame:
    """Rows ranked 1..n per key, newest first; NULL counts as oldest.

    ``order`` is NEWEST_FIRST by default, as far as ``df`` has these columns.

    The rank limit is applied before the exchange too, so a task sends at most
    n rows per key.
    """
    if order is None:
        order = [name for name in NEWEST_FIRST if name in df.columns]
    window = Window.partitionBy(key).orderBy(*[F.desc(name) for name in order])
    return df.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= n)
