"""Property tests: column helpers agree with plain-Python answers on random inputs."""

import calendar
import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from velomart.functions.calendar import is_weekend, season
from velomart.functions.daypart import hour_bucket, is_rush_hour
from velomart.functions.time import minute_boundaries_between
from velomart.functions.calendar import day_name, month_name
from velomart.functions.time import month_window, month_window_values

stamps = st.datetimes(min_value=dt.datetime(1960, 1, 1), max_value=dt.datetime(2060, 12, 31))
SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def py_minutes(a: dt.datetime, b: dt.datetime) -> int:
    def idx(t):
        return (t.date().toordinal() * 1440) + t.hour * 60 + t.minute

    return idx(b) - idx(a)


def py_bucket(h: int) -> str:
    if 6 <= h <= 9:
        return "Morning commute"
    if 10 <= h <= 15:
        return "Midday"
    if 16 <= h <= 19:
        return "Evening commute"
    return "Night / Early morning"


def py_season(m: int) -> str:
    return {12: "Winter", 1: "Winter", 2: "Winter", 3: "Spring", 4: "Spring", 5: "Spring",
            6: "Summer", 7: "Summer", 8: "Summer"}.get(m, "Fall")


@SETTINGS
@given(st.lists(st.tuples(stamps, stamps), min_size=1, max_size=40))
def test_minute_boundaries_match_python(spark, pairs):
    df = spark.createDataFrame(pairs, "a timestamp_ntz, b timestamp_ntz")
    got = [r[0] for r in df.select(minute_boundaries_between("a", "b")).collect()]
    assert got == [py_minutes(a, b) for a, b in pairs]


@SETTINGS
@given(st.lists(stamps, min_size=1, max_size=40))
def test_day_part_and_calendar_match_python(spark, values):
    df = spark.createDataFrame([(v, v.date()) for v in values], "t timestamp_ntz, d date")
    from pyspark.sql import functions as F

    rows = df.select(
        hour_bucket(F.hour("t")).alias("b"),
        is_rush_hour(F.hour("t")).alias("r"),
        season("d").alias("s"),
        is_weekend("d").alias("w"),
        day_name("d").alias("dn"),
        month_name("d").alias("mn"),
    ).collect()
    for v, r in zip(values, rows):
        assert r.b == py_bucket(v.hour)
        assert r.r == (6 <= v.hour <= 9 or 16 <= v.hour <= 19)
        assert r.s == py_season(v.month)
        assert r.w == (v.weekday() >= 5)
        assert r.dn == calendar.day_name[v.weekday()]
        assert r.mn == calendar.month_name[v.month]


@SETTINGS
@given(st.lists(st.tuples(st.integers(1900, 2100), st.integers(1, 12)), min_size=1, max_size=30))
def test_month_window_matches_python(spark, months):
    df = spark.createDataFrame(months, "y int, m int")
    first, last = month_window("y", "m")
    rows = df.select(first.alias("f"), last.alias("l")).collect()
    for (y, m), r in zip(months, rows):
        assert (r.f.isoformat(), r.l.isoformat()) == month_window_values(y, m)
        assert r.l.day == calendar.monthrange(y, m)[1]
