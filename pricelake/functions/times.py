"""Time expressions. All of them read the session zone, which is pinned to UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricelake.schemas import BAR_TIME_MAX_S, BAR_TIME_MIN_S

# Formats of the stored and displayed texts (fixed values).
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
TIME_IN_TIMESTAMP = (12, 8)  # where HH:mm:ss is in that text
DISPLAY_FORMAT = "MMMM d, yyyy 'at' hh:mm:ss a"
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def epoch_millis(time: Column) -> Column:
    """Milliseconds as a long; text that is no number becomes null.

    A fractional text (``1364774820000.0``) is cut to its whole part.
    """
    text = time.cast("string")
    return F.coalesce(
        text.try_cast("bigint"),
        text.try_cast("decimal(38,6)").try_cast("bigint"),
    )


def epoch_seconds(millis: Column) -> Column:
    """Whole seconds, cut towards zero, null outside years 1 to 9999."""
    seconds = (millis / F.lit(1000)).cast("bigint")
    return F.when(seconds.between(BAR_TIME_MIN_S, BAR_TIME_MAX_S), seconds)


def parse_time(text: Column) -> Column:
    """ISO text to a timestamp; anything else becomes null."""
    return F.try_to_timestamp(text)


def display_time(timestamp: Column) -> Column:
    """Long English text for the live view."""
    return F.date_format(timestamp, DISPLAY_FORMAT)
