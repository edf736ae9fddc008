"""Join helpers on days and month folders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


TRIP_MONTH = "trip_month"


def with_trip_month(df: DataFrame, day_col: str = "trip_date") -> DataFrame:
    """Add the storage partition column ``trip_month`` (first day of the month)."""
    return df.withColumn(TRIP_MONTH, F.trunc(F.col(day_col), "MM"))


def restrict_to_days(facts: DataFrame, days: DataFrame, day_col: str = "trip_date") -> DataFrame:
    """Keep the fact rows whose ``day_col`` appears in ``days`` (a left-semi join).

    ``days`` is the day-grain output of the report filters, so no date list is
    collected to the driver.  When the facts are stored in month folders the
    join also keys on ``trip_month``: Spark then prunes month folders
    dynamically from the selected days (the day side is small and broadcast).
    """
    # No distinct(): a left-semi join never multiplies rows, so duplicate keys
    # on the day side cost nothing and need no extra shuffle.
    keys = days.select(F.col(day_col).alias("__day"))
    if TRIP_MONTH not in facts.columns:
        return facts.join(keys, facts[day_col] == keys["__day"], "left_semi")
    keys = keys.withColumn("__month", F.trunc(F.col("__day"), "MM"))
    cond = (facts[TRIP_MONTH] == keys["__month"]) & (facts[day_col] == keys["__day"])
    return facts.join(keys, cond, "left_semi")
