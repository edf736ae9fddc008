"""Weather reshaping: long observations -> one row per day with five measures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Observation kinds kept, and the column each becomes.
OBSERVATION_TO_COLUMN = {
    "TMAX": "temperature_max_c",
    "TMIN": "temperature_min_c",
    "PRCP": "precipitation_mm",
    "SNOW": "snowfall_mm",
    "AWND": "avg_wind_speed_mps",
}


def pivot_observations(observations: DataFrame) -> DataFrame:
    """Pivot (obs_date, datatype, value, seq) to (weather_date, 5 measures).

    Per day and kind the value is the *first non-null* one in ``seq`` order, so
    the result does not depend on task scheduling.  Kinds outside the fixed list
    are dropped before the shuffle; a day whose values are all null has no row;
    a kind that never occurs gives a null column rather than a missing one.

    The pivot is written as one conditional aggregate per kind: one shuffle of at most
    one partial row per day per task.  ``seq`` is a number, so Spark aggregates by hash.
    """
    kinds = list(OBSERVATION_TO_COLUMN)
    kept = observations.where(F.col("datatype").isin(*kinds) & F.col("value").isNotNull()).select(
        "obs_date", "datatype", "value", "seq"
    )
    measures = [
        F.min_by(F.col("value"), F.when(F.col("datatype") == kind, F.col("seq"))).alias(column)
        for kind, column in OBSERVATION_TO_COLUMN.items()
    ]
    return kept.groupBy(F.col("obs_date").alias("weather_date")).agg(*measures)
