"""Mart semantics on hand-made trips (the traps of the survey)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from velomart.operators import marts
from velomart.operators.staging import stage_trips
from velomart.sources.seed import read_holidays

COLS = (
    "ride_id string, rideable_type string, started_at timestamp_ntz, ended_at timestamp_ntz, "
    "start_station_name string, start_station_id string, end_station_name string, end_station_id string, "
    "start_lat double, start_lng double, end_lat double, end_lng double, member_casual string"
)


def t(s):
    return dt.datetime.fromisoformat(s)


@pytest.fixture()
def staged(spark):
    rows = [
        # rid, start, end, sname, sid, ename, eid, coords, rider
        ("1", t("2024-07-04 08:15:00"), t("2024-07-04 08:30:10"), "A", "SA", "B", "SB", 40.0, -74.0, 41.0, -73.0, "member"),
        ("2", t("2024-07-04 08:45:00"), t("2024-07-04 08:40:00"), "A", "SA", "B", "SB", 40.5, -74.5, 41.0, -73.0, "casual"),
        ("3", t("2024-07-04 10:00:00"), t("2024-07-04 10:05:00"), "A", "SA", "A", "SA", 40.0, -74.0, 40.0, -74.0, "member"),
        ("4", t("2024-07-04 10:20:00"), t("2024-07-04 10:25:00"), None, "SA", None, "SB", 40.0, -74.0, 41.0, -73.0, "unknown"),
        ("5", t("2024-07-05 23:59:59"), t("2024-07-06 00:00:01"), "C", "SC", "B", "SB", None, -74.0, 41.0, -73.0, "casual"),
    ]
    raw = spark.createDataFrame(
        [(r[0], "classic_bike", r[1], r[2], r[3], r[4], r[5], r[6], r[7], r[8], r[9], r[10], r[11]) for r in rows],
        COLS,
    )
    return stage_trips(raw)


def test_trip_facts_drop_negative_durations(staged):
    facts = {r.ride_id: r for r in marts.trip_facts(staged).collect()}
    assert set(facts) == {"1", "3", "4", "5"}
    assert facts["1"].trip_duration_minutes == 15
    assert facts["5"].trip_duration_minutes == 1 and facts["5"].trip_date == dt.date(2024, 7, 5)


def test_daily_counts_riders_and_totals(staged):
    daily = {r.trip_date: r for r in marts.trip_daily(marts.trip_facts(staged)).collect()}
    d = daily[dt.date(2024, 7, 4)]
    assert (d.total_trips, d.member_trips, d.casual_trips) == (3, 2, 0)
    assert d.avg_trip_duration_minutes == pytest.approx((15 + 5 + 5) / 3)


def test_station_daily_keeps_negative_and_needs_names(staged):
    rows = marts.station_daily(staged).collect()
    a = [r for r in rows if r.station_id == "SA"]
    assert len(a) == 1 and a[0].trip_count == 3  # rides 1, 2, 3 (4 has no name)
    assert a[0].lat == pytest.approx((40.0 + 40.5 + 40.0) / 3)
    assert all(r.station_id != "SC" for r in rows)  # null start_lat


def test_station_hourly_labels(staged):
    rows = {(r.trip_hour, r.station_id): r for r in marts.station_hourly(staged).collect()}
    assert rows[(8, "SA")].hour_bucket == "Morning commute" and rows[(8, "SA")].is_rush_hour
    assert rows[(10, "SA")].hour_bucket == "Midday" and not rows[(10, "SA")].is_rush_hour


def test_flows_daily_keeps_self_loops_hourly_drops_them(staged):
    daily = marts.flows_daily(staged).collect()
    assert any(r.start_station_id == r.end_station_id for r in daily)
    assert all(r.start_station_name is not None for r in daily)
    hourly = marts.flows_hourly(staged).collect()
    assert all(r.start_station_id != r.end_station_id for r in hourly)
    # names may be null in the hourly flows
    assert any(r.start_station_name is None for r in hourly)


def test_enriched_joins_weather_and_holidays(spark, staged):
    daily = marts.trip_daily(marts.trip_facts(staged))
    weather = spark.createDataFrame(
        [(dt.date(2024, 7, 4), 30.0, 20.0, 0.0, 0.0, 3.1)],
        "weather_date date, temperature_max_c double, temperature_min_c double, precipitation_mm double, "
        "snowfall_mm double, avg_wind_speed_mps double",
    )
    rows = {r.trip_date: r for r in marts.daily_enriched(daily, weather, read_holidays(spark)).collect()}
    july4, july5 = rows[dt.date(2024, 7, 4)], rows[dt.date(2024, 7, 5)]
    assert july4.is_holiday and july4.holiday_name == "Independence Day" and july4.temperature_max_c == 30.0
    assert july5.is_holiday is False and july5.holiday_name is None and july5.temperature_max_c is None
    assert (july4.month_number, july4.month_name, july4.day_name, july4.season) == (7, "July", "Thursday", "Summer")
    assert july4.is_weekend is False


def test_top_flows_daily_splits_pair_by_daily_coordinates(spark):
    """Daily top flows group by the daily mean coordinates: one OD pair whose
    means differ between days gives two rows; the hourly version averages them."""
    from velomart.operators import reports

    rows = [
        (dt.date(2024, 1, 1), 8, "A", "An", 40.0, -74.0, "B", "Bn", 41.0, -73.0, 3, 2, 1),
        (dt.date(2024, 1, 2), 8, "A", "An", 40.5, -74.0, "B", "Bn", 41.0, -73.0, 1, 1, 0),
    ]
    schema = (
        "trip_date date, trip_hour int, start_station_id string, start_station_name string, start_lat double, "
        "start_lng double, end_station_id string, end_station_name string, end_lat double, end_lng double, "
        "trip_count long, member_trips long, casual_trips long"
    )
    flows = spark.createDataFrame(rows, schema)
    days = flows.select("trip_date").distinct()
    daily = reports.top_flows_daily(flows.drop("trip_hour"), days).collect()
    assert [(r.start_lat, r.trip_count) for r in daily] == [(40.0, 3), (40.5, 1)]
    hourly_in = flows.withColumn("hour_bucket", F.lit("Morning commute")).withColumn("is_rush_hour", F.lit(True))
    hourly = reports.top_flows_hourly(hourly_in, days).collect()
    assert [(r.start_lat, r.trip_count) for r in hourly] == [(40.25, 4)]


def test_hourly_leaders_combine_ids_by_name(spark):
    from velomart.operators import reports

    rows = [("S1", "Hub", 5, 3, 2), ("S2", "Hub", 4, 4, 0), ("S3", "Side", 6, 6, 0)]
    sel = spark.createDataFrame(
        rows, "station_id string, station_name string, trip_count long, member_trips long, casual_trips long"
    ).withColumn("trip_hour", F.lit(8))
    leaders = reports.hourly_leaders(sel).collect()
    assert [(r.station_name, r.trip_count) for r in leaders] == [("Hub", 9), ("Side", 6)]
