"""Time-of-day classification of a trip start: hour, bucket, rush-hour flag."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hour buckets (inclusive whole hours) and their labels.
MORNING_COMMUTE = (6, 9)
MIDDAY = (10, 15)
EVENING_COMMUTE = (16, 19)
HOUR_BUCKETS = ["Morning commute", "Midday", "Evening commute", "Night / Early morning"]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trip_hour(ts: Column | str) -> Column:
    """Hour of day (0-23) of a wall-clock timestamp, as INT."""
    return F.hour(_col(ts))


def hour_bucket(hour: Column | str) -> Column:
    h = _col(hour)
    return (
        F.when(h.between(*MORNING_COMMUTE), HOUR_BUCKETS[0])
        .when(h.between(*MIDDAY), HOUR_BUCKETS[1])
        .when(h.between(*EVENING_COMMUTE), HOUR_BUCKETS[2])
        .otherwise(HOUR_BUCKETS[3])
    )


def is_rush_hour(hour: Column | str) -> Column:
    """Morning or evening commute hour; false (never null) otherwise."""
    h = _col(hour)
    return F.coalesce(h.between(*MORNING_COMMUTE) | h.between(*EVENING_COMMUTE), F.lit(False))

