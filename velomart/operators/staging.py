"""Staging relations: typed projections of the bronze tables (lazy, never stored)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velomart.schemas import STAGED_TRIP_COLUMNS, WEATHER_MEASURES

_TIMESTAMP_COLUMNS = {"started_at", "ended_at"}


def stage_trips(bronze: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The 13 trip columns (and ``keep``); both timestamps cast to wall-clock TIMESTAMP_NTZ.

    Extra CSV columns of the bronze table are dropped here, which also prunes
    them from the parquet scan.
    """
    return bronze.select(
        *[
            F.col(c).cast("timestamp_ntz").alias(c) if c in _TIMESTAMP_COLUMNS else F.col(c)
            for c in STAGED_TRIP_COLUMNS
        ],
        *keep,
    )


def stage_weather(bronze: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """weather_date as DATE and the five measures as DOUBLE (and ``keep``)."""
    return bronze.select(
        F.col("weather_date").cast("date").alias("weather_date"),
        *[F.col(c).cast("double").alias(c) for c in WEATHER_MEASURES],
        *keep,
    )
