"""Event time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EVENT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def event_time(text: Column) -> Column:
    """Timestamp from source text; text in another format gives NULL."""
    return F.try_to_timestamp(text, F.lit(EVENT_TIME_FORMAT))


def event_second(ts: Column) -> Column:
    """Whole epoch seconds, rounded down: the ordering key of the range windows."""
    return F.unix_timestamp(ts)


def is_night(ts: Column) -> Column:
    return F.hour(ts).between(0, 5)


def is_weekend(ts: Column) -> Column:
    return F.dayofweek(ts).isin(1, 7)  # 1 is Sunday
