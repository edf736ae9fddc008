"""Hand-written rows with known answers for the column helpers."""

import datetime as dt

from pyspark.sql import functions as F

from velomart.functions.calendar import is_weekend, season
from velomart.functions.daypart import hour_bucket, is_rush_hour
from velomart.functions.metrics import flow_weight, guarded_share
from velomart.functions.time import minute_boundaries_between, month_window, month_window_values, previous_month, yyyymm, zero_pad_month
from velomart.functions.calendar import day_name, month_name, month_number
from velomart.plans.monthly import previous_month_of


def ts(s):
    return dt.datetime.fromisoformat(s)


def test_minute_boundaries(spark):
    rows = [
        (ts("2024-01-01 10:00:59"), ts("2024-01-01 10:01:00"), 1),
        (ts("2024-01-01 10:00:00"), ts("2024-01-01 10:00:59"), 0),
        (ts("2024-01-01 10:05:01"), ts("2024-01-01 10:00:59"), -5),
        (ts("2024-12-31 23:59:30"), ts("2025-01-01 00:00:10"), 1),
        (ts("1965-03-01 00:00:30"), ts("1965-03-01 00:01:00"), 1),
    ]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz, want int")
    got = df.select(minute_boundaries_between("a", "b").alias("got"), "want").collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_minute_boundaries_ignore_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame(
            [
                (ts("2024-03-10 01:59:00"), ts("2024-03-10 03:01:00"), 62),
                (ts("2024-03-10 01:29:47"), ts("2024-03-10 02:46:56"), 77),
                (ts("2024-03-10 02:06:40"), ts("2024-03-10 03:59:36"), 113),
                (ts("2024-11-03 01:30:00"), ts("2024-11-03 01:10:00"), -20),
            ],
            "a timestamp_ntz, b timestamp_ntz, want int",
        )
        got = df.select(minute_boundaries_between("a", "b").alias("got"), "want").collect()
        assert [r.got for r in got] == [r.want for r in got]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_buckets_and_rush_edges(spark):
    hours = [5, 6, 9, 10, 15, 16, 19, 20, 0, 23]
    df = spark.createDataFrame([(h,) for h in hours], "h int")
    got = df.select(hour_bucket("h").alias("b"), is_rush_hour("h").alias("r")).collect()
    assert [r.b for r in got] == [
        "Night / Early morning",
        "Morning commute",
        "Morning commute",
        "Midday",
        "Midday",
        "Evening commute",
        "Evening commute",
        "Night / Early morning",
        "Night / Early morning",
        "Night / Early morning",
    ]
    assert [r.r for r in got] == [False, True, True, False, False, True, True, False, False, False]


def test_rush_hour_on_null_is_false(spark):
    df = spark.createDataFrame([(None,)], "h int")
    assert df.select(is_rush_hour("h")).first()[0] is False


def test_calendar(spark):
    days = [dt.date(2024, 5, 4), dt.date(2024, 5, 5), dt.date(2024, 5, 6)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = df.select(
        is_weekend("d").alias("w"), day_name("d").alias("n"), month_name("d").alias("m"), month_number("d").alias("k")
    ).collect()
    assert [r.w for r in got] == [True, True, False]
    assert [r.n for r in got] == ["Saturday", "Sunday", "Monday"]
    assert {r.m for r in got} == {"May"} and {r.k for r in got} == {5}


def test_season_edges(spark):
    months = [2, 3, 5, 6, 8, 9, 11, 12]
    df = spark.createDataFrame([(dt.date(2024, m, 1),) for m in months], "d date")
    got = [r[0] for r in df.select(season("d")).collect()]
    assert got == ["Winter", "Spring", "Spring", "Summer", "Summer", "Fall", "Fall", "Winter"]


def test_month_window(spark):
    df = spark.createDataFrame([(2024, 2), (2025, 12)], "y int, m int")
    first, last = month_window("y", "m")
    got = df.select(first.alias("f"), last.alias("l")).collect()
    assert [(r.f, r.l) for r in got] == [
        (dt.date(2024, 2, 1), dt.date(2024, 2, 29)),
        (dt.date(2025, 12, 1), dt.date(2025, 12, 31)),
    ]
    assert month_window_values(2024, 2) == ("2024-02-01", "2024-02-29")
    assert month_window_values(2025, 12) == ("2025-12-01", "2025-12-31")


def test_previous_month(spark):
    df = spark.createDataFrame([(dt.date(2026, 1, 5),)], "d date")
    row = df.select(previous_month(F.col("d")).alias("p")).first()
    assert row.p == dt.date(2025, 12, 1)
    assert previous_month_of(dt.date(2026, 1, 5)) == (2025, 12)
    assert previous_month_of(dt.date(2024, 3, 31)) == (2024, 2)


def test_padding_and_period(spark):
    df = spark.createDataFrame([(4, dt.date(2025, 4, 9))], "m int, d date")
    row = df.select(zero_pad_month("m").alias("mm"), yyyymm("d").alias("p")).first()
    assert (row.mm, row.p) == ("04", "202504")


def test_guarded_share_and_weight(spark):
    df = spark.createDataFrame([(0, 0, 10), (3, 1, 400), (1, 3, 100)], "m long, c long, n long")
    got = df.select(
        guarded_share("m", F.col("m") + F.col("c")).alias("s"), flow_weight("n").alias("w")
    ).collect()
    assert [r.s for r in got] == [0.0, 0.75, 0.25]
    assert [r.w for r in got] == [2.0, 8.0, 5.0]
