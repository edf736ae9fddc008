"""Report semantics: day/hour filters, KPIs, rankings, reshaping."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from velomart.catalog import Inputs
from velomart.operators import reports
from velomart.operators.reports import DayFilters, HourFilters

from tables_at import SF_SMALL

DAYS = (
    "trip_date date, total_trips long, member_trips long, casual_trips long, avg_trip_duration_minutes double, "
    "temperature_max_c double, is_holiday boolean, holiday_name string, month_name string, day_name string, "
    "is_weekend boolean, season string"
)


@pytest.fixture()
def days(spark):
    rows = [
        (dt.date(2024, 5, 3), 10, 6, 3, 12.0, 20.0, False, None, "May", "Friday", False, "Spring"),
        (dt.date(2024, 5, 4), 30, 10, 20, 14.0, float("nan"), False, None, "May", "Saturday", True, "Spring"),
        (dt.date(2024, 5, 27), 30, 15, 15, 10.0, 25.0, True, "Memorial Day", "May", "Monday", False, "Spring"),
        (dt.date(2024, 12, 25), 5, 0, 0, 8.0, None, True, "Christmas Day", "December", "Wednesday", False, "Winter"),
    ]
    return spark.createDataFrame(rows, DAYS)


def dates(df, col="trip_date"):
    return sorted(r[col] for r in df.collect())


def test_day_filters(days):
    f = reports.filter_days
    assert len(dates(f(days, DayFilters(start_date="2024-05-04", end_date="2024-05-27")))) == 2
    assert dates(f(days, DayFilters(holiday=reports.HOLIDAYS_ONLY))) == [dt.date(2024, 5, 27), dt.date(2024, 12, 25)]
    assert dates(f(days, DayFilters(day_type=reports.WEEKENDS_ONLY))) == [dt.date(2024, 5, 4)]
    assert len(dates(f(days, DayFilters(day_type=reports.WEEKDAYS_ONLY, holiday=reports.NON_HOLIDAYS_ONLY)))) == 1
    assert dates(f(days, DayFilters(seasons=()))) == []
    assert len(dates(f(days, DayFilters(years=(2024,), month_names=("May",))))) == 3
    assert dates(f(days, DayFilters(dates=["2024-05-04", dt.date(2024, 12, 25)]))) == [
        dt.date(2024, 5, 4),
        dt.date(2024, 12, 25),
    ]
    assert dates(f(days, DayFilters(dates=[]))) == []
    with pytest.raises(ValueError):
        f(days, DayFilters(holiday="sometimes"))


def test_kpis_busiest_tie_goes_to_earliest(days):
    k = reports.kpis(days).first()
    assert k.total_trips == 75 and k.avg_daily_trips == pytest.approx(18.75)
    assert k.avg_trip_duration_minutes == pytest.approx(11.0)
    assert k.member_share == pytest.approx(31 / 69)
    assert k.busiest_day == dt.date(2024, 5, 4) and k.busiest_day_trips == 30


def test_kpis_zero_denominator(days):
    only_xmas = days.where(F.col("trip_date") == F.lit("2024-12-25").cast("date"))
    assert reports.kpis(only_xmas).first().member_share == 0.0


def test_weekday_profile_order_and_scatter(days):
    prof = reports.weekday_profile(days).collect()
    assert [r.day_name for r in prof] == ["Monday", "Wednesday", "Friday", "Saturday"]
    # NaN and null temperatures are both missing
    assert dates(reports.weather_scatter(days)) == [dt.date(2024, 5, 3), dt.date(2024, 5, 27)]


def test_daily_series_in_date_order(days):
    series = reports.daily_series(days).collect()
    assert [r.trip_date for r in series] == sorted(r.trip_date for r in series)
    assert series[0].asDict() == {
        "trip_date": dt.date(2024, 5, 3), "total_trips": 10, "member_trips": 6, "casual_trips": 3
    }


def test_top_days(days):
    top = reports.top_days(days, n=2).collect()
    assert [r.date for r in top] == [dt.date(2024, 5, 4), dt.date(2024, 5, 27)]
    assert "trip_date" not in top[0].asDict()


def test_hourly_views_on_fixture(spark):
    i = Inputs(spark, SF_SMALL)
    sel = reports.selected_station_hours(i.station_hourly, i.days, HourFilters())
    total = sel.agg(F.sum("trip_count")).first()[0]
    by_hour = reports.hourly_trips(sel).collect()
    assert sum(r.trip_count for r in by_hour) == total
    assert [r.trip_hour for r in by_hour] == sorted(r.trip_hour for r in by_hour)
    mix = reports.hourly_rider_mix(sel).collect()
    assert {r.rider_type for r in mix} == {"member_trips", "casual_trips"}
    assert len(mix) == 2 * len(by_hour)
    buckets = reports.bucket_trips(sel).collect()
    assert sum(r.trip_count for r in buckets) == total
    assert [r.trip_count for r in buckets] == sorted((r.trip_count for r in buckets), reverse=True)
    leaders = reports.hourly_leaders(sel).collect()
    assert len(leaders) <= 15 and len({r.station_name for r in leaders}) == len(leaders)


def test_hour_filters_and_empty_buckets(spark):
    i = Inputs(spark, SF_SMALL)
    rush = reports.selected_station_hours(i.station_hourly, i.days, HourFilters(rush=reports.RUSH_ONLY))
    assert rush.where(~F.col("is_rush_hour")).count() == 0
    narrow = reports.selected_station_hours(i.station_hourly, i.days, HourFilters(start_hour=8, end_hour=9))
    assert {r.trip_hour for r in narrow.select("trip_hour").distinct().collect()} <= {8, 9}
    empty = reports.top_flows_hourly(i.flows_hourly, i.days, HourFilters(hour_buckets=()))
    assert empty.count() == 0 and len(empty.columns) == 11


def test_top_flows_restrict_to_selected_days(spark):
    i = Inputs(spark, SF_SMALL)
    no_days = reports.filter_days(i.enriched, DayFilters(seasons=()))
    assert reports.top_flows_daily(i.flows_daily, no_days).count() == 0
    top = reports.top_flows_daily(i.flows_daily, i.days).collect()
    assert 0 < len(top) <= 100
    counts = [r.trip_count for r in top]
    assert counts == sorted(counts, reverse=True)
    weighted = reports.with_flow_weight(reports.top_flows_daily(i.flows_daily, i.days))
    assert weighted.agg(F.min("line_weight"), F.max("line_weight")).first() >= (2.0, 2.0)


def test_station_activity_drops_missing_keys(spark):
    rows = [
        (dt.date(2024, 1, 1), "S1", "One", 40.0, -74.0, 3, 2, 1),
        (dt.date(2024, 1, 2), "S1", "One", 40.0, -74.0, 2, 1, 1),
        (dt.date(2024, 1, 2), "S2", None, 41.0, -74.0, 9, 9, 0),
        (dt.date(2024, 1, 2), "S3", "Three", float("nan"), -74.0, 9, 9, 0),
    ]
    df = spark.createDataFrame(
        rows,
        "trip_date date, station_id string, station_name string, lat double, lon double, "
        "trip_count long, member_trips long, casual_trips long",
    )
    act = reports.station_activity(df).collect()
    assert [(r.station_id, r.trip_count) for r in act] == [("S1", 5)]


def test_dashboard_frames_follow_granularity(spark):
    i = Inputs(spark, SF_SMALL)
    m = {
        "fct_trip_daily_enriched": i.enriched,
        "fct_station_daily": i.station_daily,
        "fct_station_hourly": i.station_hourly,
        "fct_station_flows_daily": i.flows_daily,
        "fct_station_flows_hourly": i.flows_hourly,
    }
    daily = reports.dashboard_frames(m)
    assert "hourly_trips" not in daily and daily["kpis"].count() == 1
    hourly = reports.dashboard_frames(m, hour_filters=HourFilters(start_hour=6, end_hour=9), granularity="Hourly")
    assert {r.trip_hour for r in hourly["hourly_trips"].collect()} <= {6, 7, 8, 9}
    assert hourly["flows"].columns[-1] == "line_weight"
    with pytest.raises(ValueError):
        reports.dashboard_frames(m, granularity="Weekly")


def test_coordinates_that_differ_in_the_last_digit_are_one_key(spark):
    """Float means depend on the order of their sum: 0.1 + 0.2 + 0.3 is not 0.3 + 0.2 + 0.1."""
    a, b = (0.1 + 0.2) + 0.3, 0.1 + (0.2 + 0.3)
    assert a != b
    rows = [
        ("2024-03-01", "S1", "A", a, a, "S2", "B", b, b, 3, 1, 2),
        ("2024-03-02", "S1", "A", b, b, "S2", "B", a, a, 4, 2, 2),
    ]
    flows = spark.createDataFrame(
        rows,
        "trip_date string, start_station_id string, start_station_name string, start_lat double, start_lng double, end_station_id string, "
        "end_station_name string, end_lat double, end_lng double, trip_count long, member_trips long, casual_trips long",
    ).withColumn("trip_date", F.col("trip_date").cast("date"))
    days = flows.select("trip_date").distinct()
    assert [(r.trip_count, r.start_lat) for r in reports.top_flows_daily(flows, days).collect()] == [(7, 0.6)]
    stations = flows.select("trip_date", F.col("start_station_id").alias("station_id"), F.col("start_station_name").alias("station_name"), F.col("start_lat").alias("lat"), F.col("start_lng").alias("lon"), "trip_count", "member_trips", "casual_trips")
    assert [r.trip_count for r in reports.station_activity(stations).collect()] == [7]
