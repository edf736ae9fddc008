"""Mart builders: trip, daily, enriched-daily, station and origin-destination facts.

Each builder is ``DataFrame -> DataFrame`` over the staged relations.  Every
aggregation is a plain ``groupBy().agg()`` so Spark plans a partial (map-side)
aggregate before the shuffle: a hot station or a hot day collapses to one row
per task before anything crosses the network.  Day-part labels are functions of
the hour, so they are derived *after* aggregation instead of widening the
shuffle key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velomart.functions.calendar import day_name, is_weekend, month_name, month_number, season
from velomart.functions.daypart import hour_bucket, is_rush_hour, trip_hour
from velomart.functions.time import minute_boundaries_between, trip_day
from velomart.schemas import WEATHER_MEASURES


def _rider_counts() -> list[Column]:
    """member_trips / casual_trips: 0 (never null) when no row matches."""
    mc = F.col("member_casual")
    return [
        F.count_if(mc == "member").alias("member_trips"),
        F.count_if(mc == "casual").alias("casual_trips"),
    ]


def _not_null(*cols: str) -> Column:
    cond = F.col(cols[0]).isNotNull()
    for c in cols[1:]:
        cond = cond & F.col(c).isNotNull()
    return cond


def trip_facts(staged: DataFrame) -> DataFrame:
    """Ride-grain fact: trip_date, minute-boundary duration; negative durations dropped."""
    started, ended = F.col("started_at"), F.col("ended_at")
    return staged.where(ended >= started).select(
        "ride_id",
        "rideable_type",
        "started_at",
        "ended_at",
        trip_day(started).alias("trip_date"),
        minute_boundaries_between(started, ended).alias("trip_duration_minutes"),
        "start_station_id",
        "start_station_name",
        "end_station_id",
        "end_station_name",
        "member_casual",
    )


def trip_daily(facts: DataFrame) -> DataFrame:
    """Day-grain totals: trips, member and casual trips, mean duration."""
    return facts.groupBy("trip_date").agg(
        F.count(F.lit(1)).alias("total_trips"),
        *_rider_counts(),
        F.avg("trip_duration_minutes").alias("avg_trip_duration_minutes"),
    )


def station_daily(staged: DataFrame) -> DataFrame:
    """Start-station activity per day (rows with a complete start location only)."""
    keys = ["trip_date", "station_id", "station_name"]
    return (
        staged.where(_not_null("start_station_id", "start_station_name", "start_lat", "start_lng"))
        .select(
            trip_day("started_at").alias("trip_date"),
            F.col("start_station_id").alias("station_id"),
            F.col("start_station_name").alias("station_name"),
            "start_lat",
            "start_lng",
            "member_casual",
        )
        .groupBy(*keys)
        .agg(
            F.avg("start_lat").alias("lat"),
            F.avg("start_lng").alias("lon"),
            F.count(F.lit(1)).alias("trip_count"),
            *_rider_counts(),
        )
    )


def station_hourly(staged: DataFrame) -> DataFrame:
    """Start-station activity per day and hour, with bucket and rush-hour flag."""
    keys = ["trip_date", "trip_hour", "station_id", "station_name"]
    agg = (
        staged.where(_not_null("start_station_id", "start_station_name", "start_lat", "start_lng"))
        .select(
            trip_day("started_at").alias("trip_date"),
            trip_hour("started_at").alias("trip_hour"),
            F.col("start_station_id").alias("station_id"),
            F.col("start_station_name").alias("station_name"),
            "start_lat",
            "start_lng",
            "member_casual",
        )
        .groupBy(*keys)
        .agg(
            F.avg("start_lat").alias("lat"),
            F.avg("start_lng").alias("lon"),
            F.count(F.lit(1)).alias("trip_count"),
            *_rider_counts(),
        )
    )
    return agg.select(
        "trip_date",
        "trip_hour",
        hour_bucket("trip_hour").alias("hour_bucket"),
        is_rush_hour("trip_hour").alias("is_rush_hour"),
        "station_id",
        "station_name",
        "lat",
        "lon",
        "trip_count",
        "member_trips",
        "casual_trips",
    )


_FLOW_OUTPUT = [
    "start_station_id",
    "start_station_name",
    "start_lat",
    "start_lng",
    "end_station_id",
    "end_station_name",
    "end_lat",
    "end_lng",
    "trip_count",
    "member_trips",
    "casual_trips",
]
_FLOW_INPUT = [
    "start_station_id",
    "start_station_name",
    "end_station_id",
    "end_station_name",
    "start_lat",
    "start_lng",
    "end_lat",
    "end_lng",
    "member_casual",
]


def _flow_aggs() -> list[Column]:
    return [
        F.avg("start_lat").alias("start_lat"),
        F.avg("start_lng").alias("start_lng"),
        F.avg("end_lat").alias("end_lat"),
        F.avg("end_lng").alias("end_lng"),
        F.count(F.lit(1)).alias("trip_count"),
        *_rider_counts(),
    ]


def flows_daily(staged: DataFrame) -> DataFrame:
    """Origin-destination trips per day; both ids, names and all four coordinates
    must be present.  Self-loops are kept."""
    complete = _not_null(
        "start_station_id",
        "start_station_name",
        "end_station_id",
        "end_station_name",
        "start_lat",
        "start_lng",
        "end_lat",
        "end_lng",
    )
    keys = ["trip_date", "start_station_id", "start_station_name", "end_station_id", "end_station_name"]
    return (
        staged.where(complete)
        .select(trip_day("started_at").alias("trip_date"), *_FLOW_INPUT)
        .groupBy(*keys)
        .agg(*_flow_aggs())
        .select("trip_date", *_FLOW_OUTPUT)
    )


def flows_hourly(staged: DataFrame) -> DataFrame:
    """Origin-destination trips per day and hour.  Ids and coordinates must be
    present (names may be null) and self-loops are dropped."""
    cond = _not_null("start_station_id", "end_station_id", "start_lat", "start_lng", "end_lat", "end_lng") & (
        F.col("start_station_id") != F.col("end_station_id")
    )
    keys = [
        "trip_date",
        "trip_hour",
        "start_station_id",
        "start_station_name",
        "end_station_id",
        "end_station_name",
    ]
    agg = (
        staged.where(cond)
        .select(
            trip_day("started_at").alias("trip_date"),
            trip_hour("started_at").alias("trip_hour"),
            *_FLOW_INPUT,
        )
        .groupBy(*keys)
        .agg(*_flow_aggs())
    )
    return agg.select(
        "trip_date",
        "trip_hour",
        hour_bucket("trip_hour").alias("hour_bucket"),
        is_rush_hour("trip_hour").alias("is_rush_hour"),
        *_FLOW_OUTPUT,
    )


def daily_enriched(daily: DataFrame, weather: DataFrame, holidays: DataFrame) -> DataFrame:
    """Daily facts with weather, holiday and calendar context (left joins on the date).

    Both ``daily`` and the weather pivot come out of aggregations keyed by the
    date, so the weather join needs no extra shuffle, and AQE turns it into a
    broadcast join when the runtime size of either side is small; the same holds for
    the holiday seed.
    """
    w = weather.select(F.col("weather_date"), *WEATHER_MEASURES)
    h = holidays.select("holiday_date", "holiday_name", "is_holiday")
    d = F.col("trip_date")
    return (
        daily.join(w, d == F.col("weather_date"), "left")
        .join(h, d == F.col("holiday_date"), "left")
        .select(
            "trip_date",
            "total_trips",
            "member_trips",
            "casual_trips",
            "avg_trip_duration_minutes",
            *WEATHER_MEASURES,
            F.coalesce(F.col("is_holiday"), F.lit(False)).alias("is_holiday"),
            "holiday_name",
            month_number(d).alias("month_number"),
            month_name(d).alias("month_name"),
            day_name(d).alias("day_name"),
            is_weekend(d).alias("is_weekend"),
            season(d).alias("season"),
        )
    )


def mart_sort_keys(name: str) -> list[Column]:
    """Storage order of each mart.  Readers apply it with ``orderBy``; writers use
    it as the within-file sort so parquet min/max statistics skip by date."""
    keys = {
        "fct_trips": [F.col("trip_date")],
        "fct_trip_daily": [F.col("trip_date")],
        "fct_trip_daily_enriched": [F.col("trip_date")],
        "fct_station_daily": [F.col("trip_date"), F.col("trip_count").desc()],
        "fct_station_hourly": [F.col("trip_date"), F.col("trip_hour"), F.col("trip_count").desc()],
        "fct_station_flows_daily": [F.col("trip_date"), F.col("trip_count").desc()],
        "fct_station_flows_hourly": [F.col("trip_date"), F.col("trip_hour"), F.col("trip_count").desc()],
    }
    return keys[name]
