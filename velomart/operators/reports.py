"""Report queries over the marts: day filters, KPIs, rankings, hourly profiles.

Reports take mart DataFrames plus plain filter objects and return DataFrames.
No date list is ever collected: the days that survive the day filters restrict
station and flow facts through a left-semi join on (trip_month, trip_date),
which prunes the stored marts' month folders dynamically.  Only top-k outputs
are bounded.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velomart.functions.calendar import DAY_NAMES
from velomart.functions.daypart import HOUR_BUCKETS
from velomart.functions.metrics import flow_weight, guarded_share
from velomart.operators.joins import restrict_to_days
from velomart.schemas import FLOW_REPORT_SCHEMA

# Choices of the three-way filters.
ALL = "All"
HOLIDAYS_ONLY, NON_HOLIDAYS_ONLY = "Holidays only", "Non-holidays only"
WEEKDAYS_ONLY, WEEKENDS_ONLY = "Weekdays only", "Weekends only"
RUSH_ONLY, NON_RUSH_ONLY = "Rush hours only", "Non-rush hours only"

# Result sizes of the ranked views.
TOP_FLOWS = 100
MAP_STATIONS = 300
TABLE_STATIONS = 15
HOURLY_LEADERS = 15
TOP_DAYS = 10


@dataclass(frozen=True)
class DayFilters:
    """Day-level filters.  ``None`` means "no restriction"; an empty sequence
    selects nothing (as an empty multi-select does)."""

    start_date: dt.date | str | None = None
    end_date: dt.date | str | None = None
    seasons: Sequence[str] | None = None
    day_names: Sequence[str] | None = None
    years: Sequence[int] | None = None
    month_names: Sequence[str] | None = None
    holiday: str = ALL
    day_type: str = ALL
    dates: Sequence[dt.date | str] | None = None  # an explicit list of days


@dataclass(frozen=True)
class HourFilters:
    """Hour-level filters of the hourly view (hours inclusive)."""

    start_hour: int = 0
    end_hour: int = 23
    hour_buckets: Sequence[str] = field(default_factory=lambda: tuple(HOUR_BUCKETS))
    rush: str = ALL


def _isin(col: Column, values: Sequence) -> Column:
    values = list(values)
    return col.isin(*values) if values else F.lit(False)


def _as_date(value: dt.date | str) -> Column:
    return F.lit(value).cast("date")


def _three_way(col: Column, choice: str, true_choice: str, false_choice: str) -> Column | None:
    if choice == true_choice:
        return col == F.lit(True)
    if choice == false_choice:
        return col == F.lit(False)
    if choice != ALL:
        raise ValueError(f"unknown filter choice {choice!r}")
    return None


def filter_days(enriched: DataFrame, f: DayFilters = DayFilters()) -> DataFrame:
    """Apply the day filters to the enriched daily mart."""
    d = F.col("trip_date")
    conds: list[Column] = []
    if f.start_date is not None:
        conds.append(d >= _as_date(f.start_date))
    if f.end_date is not None:
        conds.append(d <= _as_date(f.end_date))
    if f.seasons is not None:
        conds.append(_isin(F.col("season"), f.seasons))
    if f.day_names is not None:
        conds.append(_isin(F.col("day_name"), f.day_names))
    if f.years is not None:
        conds.append(_isin(F.year(d), f.years))
    if f.month_names is not None:
        conds.append(_isin(F.col("month_name"), f.month_names))
    if f.dates is not None:
        conds.append(_isin(d, [F.lit(v).cast("date") for v in f.dates]))
    for cond in (
        _three_way(F.col("is_holiday"), f.holiday, HOLIDAYS_ONLY, NON_HOLIDAYS_ONLY),
        _three_way(F.col("is_weekend"), f.day_type, WEEKENDS_ONLY, WEEKDAYS_ONLY),
    ):
        if cond is not None:
            conds.append(cond)
    out = enriched
    for cond in conds:
        out = out.where(cond)
    return out


def filter_hours(hourly: DataFrame, h: HourFilters = HourFilters()) -> DataFrame:
    """Hour range, bucket membership and rush-hour choice on an hourly mart."""
    out = hourly.where(F.col("trip_hour").between(h.start_hour, h.end_hour)).where(
        _isin(F.col("hour_bucket"), h.hour_buckets)
    )
    rush = _three_way(F.col("is_rush_hour"), h.rush, RUSH_ONLY, NON_RUSH_ONLY)
    return out.where(rush) if rush is not None else out


# ---------------------------------------------------------------- day-level reports


def kpis(days: DataFrame) -> DataFrame:
    """One row: total trips, mean daily trips, mean of the daily mean durations,
    member share of member+casual trips, and the busiest day (ties -> earliest)."""
    member, casual = F.sum("member_trips"), F.sum("casual_trips")
    busiest_key = F.struct(F.col("total_trips"), -F.unix_date(F.col("trip_date")))
    return days.agg(
        F.sum("total_trips").cast("bigint").alias("total_trips"),
        F.avg("total_trips").alias("avg_daily_trips"),
        F.avg("avg_trip_duration_minutes").alias("avg_trip_duration_minutes"),
        guarded_share(member, member + casual).alias("member_share"),
        F.max_by("trip_date", busiest_key).alias("busiest_day"),
        F.max("total_trips").alias("busiest_day_trips"),
    )


def date_bounds(enriched: DataFrame) -> DataFrame:
    return enriched.agg(F.min("trip_date").alias("min_date"), F.max("trip_date").alias("max_date"))


def season_options(enriched: DataFrame) -> DataFrame:
    return enriched.select("season").where(F.col("season").isNotNull()).distinct().orderBy("season")


def year_options(enriched: DataFrame) -> DataFrame:
    return enriched.select(F.year("trip_date").alias("year")).distinct().orderBy("year")


def weekday_profile(days: DataFrame) -> DataFrame:
    """Mean trips per weekday, ordered Monday..Sunday (``day_order`` 1..7)."""
    order = F.array_position(F.array(*[F.lit(n) for n in DAY_NAMES]), F.col("day_name")).cast("int")
    return (
        days.where(F.col("day_name").isNotNull())
        .groupBy("day_name")
        .agg(F.avg("total_trips").alias("avg_total_trips"))
        .select("day_name", order.alias("day_order"), "avg_total_trips")
        .orderBy("day_order")
    )


def weather_scatter(days: DataFrame) -> DataFrame:
    """Trips vs temperature points: days with all four values present (NaN counts as missing)."""
    cols = ["trip_date", "total_trips", "temperature_max_c", "season"]
    return days.select(*cols).dropna(how="any", subset=cols)


def daily_series(days: DataFrame) -> DataFrame:
    """Trips over time and the member / casual split per day, in date order."""
    return days.select("trip_date", "total_trips", "member_trips", "casual_trips").orderBy("trip_date")


def top_days(days: DataFrame, n: int = TOP_DAYS) -> DataFrame:
    """Busiest days with context; ties broken by the earlier date."""
    return (
        days.select(
            F.col("trip_date").alias("date"),
            "total_trips",
            "member_trips",
            "casual_trips",
            "avg_trip_duration_minutes",
            "holiday_name",
            "temperature_max_c",
        )
        .orderBy(F.col("total_trips").desc_nulls_last(), F.col("date").asc_nulls_last())
        .limit(n)
    )


# ---------------------------------------------------------------- flows


_FLOW_KEYS_DAILY = [
    "start_station_id",
    "start_station_name",
    "start_lat",
    "start_lng",
    "end_station_id",
    "end_station_name",
    "end_lat",
    "end_lng",
]
_FLOW_KEYS_HOURLY = ["start_station_id", "start_station_name", "end_station_id", "end_station_name"]


def _sums() -> list[Column]:
    return [
        F.sum("trip_count").alias("trip_count"),
        F.sum("member_trips").alias("member_trips"),
        F.sum("casual_trips").alias("casual_trips"),
    ]


def _ranked(df: DataFrame, tie_keys: Sequence[str], n: int) -> DataFrame:
    """Top ``n`` by trip_count desc; ties broken by the keys (nulls last)."""
    order = [F.col("trip_count").desc_nulls_last()] + [F.col(k).asc_nulls_last() for k in tie_keys]
    return df.orderBy(*order).limit(n)


#: Decimal places at which mean coordinates are one group key: about 0.1 m, above the
#: last digits that the order of a float sum leaves open.
COORDINATE_DIGITS = 6


def _rounded(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), COORDINATE_DIGITS) for c in columns})


def top_flows_daily(flows_daily: DataFrame, days: DataFrame, n: int = TOP_FLOWS) -> DataFrame:
    """Busiest origin-destination flows over the selected days.

    Groups by ids, names *and* the daily mean coordinates (an OD pair whose mean
    coordinates differ between days yields several rows)."""
    picked = restrict_to_days(flows_daily, days)
    picked = _rounded(picked, ["start_lat", "start_lng", "end_lat", "end_lng"])
    agg = picked.groupBy(*_FLOW_KEYS_DAILY).agg(*_sums())
    return _ranked(agg, _FLOW_KEYS_DAILY, n).select(*FLOW_REPORT_SCHEMA.names)


def top_flows_hourly(
    flows_hourly: DataFrame, days: DataFrame, hours: HourFilters = HourFilters(), n: int = TOP_FLOWS
) -> DataFrame:
    """Busiest flows over the selected days and hours; coordinates are the plain
    mean of the hourly means."""
    picked = filter_hours(restrict_to_days(flows_hourly, days), hours)
    agg = picked.groupBy(*_FLOW_KEYS_HOURLY).agg(
        F.avg("start_lat").alias("start_lat"),
        F.avg("start_lng").alias("start_lng"),
        F.avg("end_lat").alias("end_lat"),
        F.avg("end_lng").alias("end_lng"),
        *_sums(),
    )
    return _ranked(agg, _FLOW_KEYS_HOURLY, n).select(*FLOW_REPORT_SCHEMA.names)


def with_flow_weight(flows: DataFrame) -> DataFrame:
    """Add the map line weight of each flow."""
    return flows.withColumn("line_weight", flow_weight("trip_count"))


def flow_table(flows: DataFrame) -> DataFrame:
    """Display table of flows with origin/destination names (and the map line
    weight when present)."""
    extra = ["line_weight"] if "line_weight" in flows.columns else []
    return flows.select(
        F.col("start_station_name").alias("origin_station"),
        F.col("end_station_name").alias("destination_station"),
        "trip_count",
        "member_trips",
        "casual_trips",
        *extra,
    )


# ---------------------------------------------------------------- stations


_STATION_KEYS = ["station_id", "station_name", "lat", "lon"]


def station_activity(station_facts: DataFrame) -> DataFrame:
    """Trips per station location over the selected rows, busiest first.

    Rows with a missing key (null or NaN) are dropped before grouping."""
    located = _rounded(station_facts.dropna(how="any", subset=_STATION_KEYS), ["lat", "lon"])
    agg = located.groupBy(*_STATION_KEYS).agg(*_sums())
    return agg.orderBy(
        F.col("trip_count").desc_nulls_last(), *[F.col(k).asc_nulls_last() for k in _STATION_KEYS]
    )


def station_activity_daily(station_daily: DataFrame, days: DataFrame) -> DataFrame:
    return station_activity(restrict_to_days(station_daily, days))


def station_activity_hourly(
    station_hourly: DataFrame, days: DataFrame, hours: HourFilters = HourFilters()
) -> DataFrame:
    return station_activity(selected_station_hours(station_hourly, days, hours))


def map_stations(activity: DataFrame, n: int = MAP_STATIONS) -> DataFrame:
    """The stations drawn on the map (first ``n`` of the ranking)."""
    return activity.limit(n)


def station_table(activity: DataFrame, n: int = TABLE_STATIONS) -> DataFrame:
    """The station table under the map."""
    return activity.select("station_name", "trip_count", "member_trips", "casual_trips").limit(n)


# ---------------------------------------------------------------- hourly view


def selected_station_hours(
    station_hourly: DataFrame, days: DataFrame, hours: HourFilters = HourFilters()
) -> DataFrame:
    return filter_hours(restrict_to_days(station_hourly, days), hours)


def hourly_trips(selected: DataFrame) -> DataFrame:
    return (
        selected.where(F.col("trip_hour").isNotNull())
        .groupBy("trip_hour")
        .agg(F.sum("trip_count").alias("trip_count"))
        .orderBy("trip_hour")
    )


def hourly_rider_mix(selected: DataFrame) -> DataFrame:
    """Member and casual trips per hour in long form (trip_hour, rider_type, trip_count)."""
    wide = (
        selected.where(F.col("trip_hour").isNotNull())
        .groupBy("trip_hour")
        .agg(F.sum("member_trips").alias("member_trips"), F.sum("casual_trips").alias("casual_trips"))
    )
    return wide.unpivot(["trip_hour"], ["member_trips", "casual_trips"], "rider_type", "trip_count").orderBy(
        "trip_hour", "rider_type"
    )


def bucket_trips(selected: DataFrame) -> DataFrame:
    return (
        selected.where(F.col("hour_bucket").isNotNull())
        .groupBy("hour_bucket")
        .agg(F.sum("trip_count").alias("trip_count"))
        .orderBy(F.col("trip_count").desc_nulls_last(), F.col("hour_bucket"))
    )


def hourly_leaders(selected: DataFrame, n: int = HOURLY_LEADERS) -> DataFrame:
    """Busiest stations by name alone (all ids and locations of a name combined)."""
    agg = selected.where(F.col("station_name").isNotNull()).groupBy("station_name").agg(*_sums())
    return agg.orderBy(F.col("trip_count").desc_nulls_last(), F.col("station_name")).limit(n)



DAILY, HOURLY = "Daily", "Hourly"


def dashboard_frames(
    marts: dict[str, DataFrame],
    day_filters: DayFilters = DayFilters(),
    hour_filters: HourFilters = HourFilters(),
    granularity: str = DAILY,
) -> dict[str, DataFrame]:
    """Every report frame of one dashboard view, lazily, keyed by name.

    ``marts`` maps mart names to stored marts (``plans.build.load_marts``).  The
    day filters select the days once; at daily granularity station activity
    and flows come from the daily marts (hour filters do not apply), at hourly
    granularity from the hourly marts with the hour filters, plus the hourly
    profile views.  Nothing runs until a frame is used.
    """
    if granularity not in (DAILY, HOURLY):
        raise ValueError(f"unknown granularity {granularity!r}")
    days = filter_days(marts["fct_trip_daily_enriched"], day_filters)
    frames = {
        "days": days,
        "kpis": kpis(days),
        "daily_series": daily_series(days),
        "weekday_profile": weekday_profile(days),
        "weather_scatter": weather_scatter(days),
        "top_days": top_days(days),
    }
    if granularity == DAILY:
        activity = station_activity_daily(marts["fct_station_daily"], days)
        flows = top_flows_daily(marts["fct_station_flows_daily"], days)
    else:
        selected = selected_station_hours(marts["fct_station_hourly"], days, hour_filters)
        activity = station_activity(selected)
        flows = top_flows_hourly(marts["fct_station_flows_hourly"], days, hour_filters)
        frames.update(
            hourly_trips=hourly_trips(selected),
            hourly_rider_mix=hourly_rider_mix(selected),
            bucket_trips=bucket_trips(selected),
            hourly_leaders=hourly_leaders(selected),
        )
    frames.update(
        map_stations=map_stations(activity),
        station_table=station_table(activity),
        flows=with_flow_weight(flows),
        flow_table=flow_table(flows),
    )
    return frames
