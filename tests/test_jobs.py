"""Monthly ingest, ledger, build-all and the monthly run, end to end."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from velomart.catalog import Inputs
from velomart.operators.quality import DataQualityError
from velomart.plans import build, ingest
from velomart.plans.ledger import LoadLedger, pending_months
from velomart.plans.monthly import monthly_load
from velomart.sources import landing
from velomart.sources.tables import read_bronze, read_bronze_trips

from tables_at import SF_SMALL

YEAR, MONTH = 2024, 3


@pytest.fixture()
def layout(spark, scratch):
    root = scratch("deploy")
    lay = ingest.Layout(
        trips_landing=f"{root}/landing/trips",
        weather_landing=f"{root}/landing/weather",
        trips_bronze=f"{root}/bronze/trips",
        weather_bronze=f"{root}/bronze/weather",
        marts=f"{root}/marts",
        ledger=f"{root}/state/pipeline_loads",
    )
    i = Inputs(spark, SF_SMALL)
    march = (F.year("started_at") == YEAR) & (F.month("started_at") == MONTH)
    landing.write_trip_csv(i.bronze_trips.where(march), lay.landed(lay.trips_landing, YEAR, MONTH))
    landing.write_observation_pages(i.observations, lay.landed(lay.weather_landing, YEAR, MONTH))
    return lay


def test_ledger_record_lookup_pending(spark, scratch):
    ledger = LoadLedger(spark, scratch("ledger"))
    assert ledger.read().count() == 0 and not ledger.already_loaded("p", 2024, 1)
    ledger.record("p", 2024, 1, "x", status="failed")
    assert not ledger.already_loaded("p", 2024, 1)
    ledger.record("p", 2024, 1, "x")
    assert ledger.already_loaded("p", 2024, 1) and not ledger.already_loaded("q", 2024, 1)
    loaded_at = ledger.read().first().loaded_at
    assert isinstance(loaded_at, dt.datetime) and loaded_at.tzinfo is None
    requested = spark.createDataFrame([("p", 2024, 1), ("p", 2024, 2)], "pipeline_name string, year int, month int")
    assert [(r.year, r.month) for r in pending_months(requested, ledger.read()).collect()] == [(2024, 2)]


def test_monthly_ingest_is_idempotent(spark, layout):
    ledger = LoadLedger(spark, layout.ledger)
    assert ingest.ingest_trips_month(spark, layout, ledger, YEAR, MONTH) == ingest.LOADED
    n = read_bronze(spark, layout.trips_bronze).count()
    assert n > 0
    assert ingest.ingest_trips_month(spark, layout, ledger, YEAR, MONTH) == ingest.SKIPPED_EXISTS
    assert ledger.count_loads(ingest.TRIPS_PIPELINE, YEAR, MONTH) == 1
    assert ingest.ingest_trips_month(spark, layout, ledger, YEAR, MONTH, force=True) == ingest.LOADED
    assert ledger.count_loads(ingest.TRIPS_PIPELINE, YEAR, MONTH) == 2
    assert read_bronze(spark, layout.trips_bronze).count() == n
    parts = read_bronze(spark, layout.trips_bronze).select("year", "month").distinct().collect()
    assert [(r.year, r.month) for r in parts] == [(YEAR, MONTH)]


def test_ledger_alone_skips_a_month(spark, layout):
    ledger = LoadLedger(spark, layout.ledger)
    ledger.record(ingest.WEATHER_PIPELINE, YEAR, MONTH, "elsewhere")
    assert ingest.ingest_weather_month(spark, layout, ledger, YEAR, MONTH) == ingest.SKIPPED_RECORDED


def test_weather_month_window_and_empty_month(spark, layout):
    ledger = LoadLedger(spark, layout.ledger)
    assert ingest.ingest_weather_month(spark, layout, ledger, YEAR, MONTH) == ingest.LOADED
    w = spark.read.parquet(layout.weather_bronze).collect()
    assert w and all(r.weather_date.month == MONTH for r in w)
    # landed pages hold no observation for 2025-07: an empty download is an error
    layout2 = ingest.Layout(**{**layout.__dict__, "weather_landing": layout.weather_landing})
    landing_july = layout2.landed(layout2.weather_landing, 2025, 7)
    i = Inputs(spark, SF_SMALL)
    landing.write_observation_pages(i.observations, landing_july)
    with pytest.raises(ValueError, match="no weather observations"):
        ingest.ingest_weather_month(spark, layout2, ledger, 2025, 7)


def test_monthly_run_builds_marts_and_gate_stops_bad_data(spark, layout):
    with pytest.raises(DataQualityError, match="member_casual accepted_values"):
        monthly_load(spark, layout, YEAR, MONTH)
    result = monthly_load(spark, layout, YEAR, MONTH, check=False)
    assert result["trips"] == ingest.SKIPPED_EXISTS
    marts = build.load_marts(spark, layout)
    assert set(marts) == set(build.MART_ORDER)
    staged = Inputs(spark, SF_SMALL).staged.where((F.year("started_at") == YEAR) & (F.month("started_at") == MONTH))
    assert marts["fct_trips"].count() == staged.where("ended_at >= started_at").count()
    daily = marts["fct_trip_daily_enriched"]
    assert daily.count() == daily.select("trip_date").distinct().count() > 0
    assert daily.where("temperature_max_c IS NOT NULL").count() > 0
    # rebuild replaces, never appends
    before = marts["fct_station_daily"].count()
    build.build_marts(spark, layout, check=False)
    assert build.load_marts(spark, layout)["fct_station_daily"].count() == before


def test_views_allow_plain_sql(spark, layout):
    from velomart.plans.views import read_ordered_mart, register_views

    monthly_load(spark, layout, YEAR, MONTH, check=False)
    names = register_views(spark, layout)
    assert "fct_station_flows_hourly" in names and "stg_trips" in names
    top = spark.sql(
        """select start_station_id, end_station_id, sum(trip_count) as trip_count
           from fct_station_flows_daily group by 1, 2 order by trip_count desc limit 5"""
    ).collect()
    assert len(top) == 5
    ordered = read_ordered_mart(spark, layout, "fct_station_hourly").collect()
    keys = [(r.trip_date, r.trip_hour, -r.trip_count) for r in ordered]
    assert keys == sorted(keys) and "trip_month" not in ordered[0].asDict()


def test_month_refresh_equals_full_rebuild(spark, scratch):
    """Load March, then April whose file also holds late-March trips; refreshing
    only the touched months gives the same marts as rebuilding everything."""
    root = scratch("incr")
    lay = ingest.Layout(
        trips_landing=f"{root}/landing/trips",
        weather_landing=f"{root}/landing/weather",
        trips_bronze=f"{root}/bronze/trips",
        weather_bronze=f"{root}/bronze/weather",
        marts=f"{root}/marts",
        ledger=f"{root}/state/loads",
    )
    i = Inputs(spark, SF_SMALL)
    m, d = F.month("started_at"), F.dayofmonth("started_at")
    landing.write_trip_csv(i.bronze_trips.where((m == 3) & (d < 25)), lay.landed(lay.trips_landing, 2024, 3))
    landing.write_trip_csv(
        i.bronze_trips.where(((m == 3) & (d >= 25)) | (m == 4)), lay.landed(lay.trips_landing, 2024, 4)
    )
    for mm in (3, 4):
        landing.write_observation_pages(i.observations, lay.landed(lay.weather_landing, 2024, mm))
    first = monthly_load(spark, lay, 2024, 3, check=False)
    assert first["months"] == [(2024, 3)]
    second = monthly_load(spark, lay, 2024, 4, check=False)
    assert second["months"] == [(2024, 3), (2024, 4)]
    incremental = {k: sorted(map(tuple, v.drop("trip_month").collect())) for k, v in build.load_marts(spark, lay).items()}

    full_lay = ingest.Layout(**{**lay.__dict__, "marts": f"{root}/marts_full"})
    build.build_marts(spark, full_lay, check=False)
    full = {k: sorted(map(tuple, v.drop("trip_month").collect())) for k, v in build.load_marts(spark, full_lay).items()}
    assert incremental == full
    assert len(incremental["fct_trip_daily"]) == len({r[0] for r in incremental["fct_trip_daily"]}) > 40


def test_backfill_loads_only_pending_months(spark, scratch):
    from velomart.plans.monthly import backfill, requested_months

    req = requested_months(spark, ["trips"], (2023, 11), (2024, 2)).collect()
    assert [(r.year, r.month) for r in req] == [(2023, 11), (2023, 12), (2024, 1), (2024, 2)]

    root = scratch("backfill")
    lay = ingest.Layout(
        trips_landing=f"{root}/landing/trips",
        weather_landing=f"{root}/landing/weather",
        trips_bronze=f"{root}/bronze/trips",
        weather_bronze=f"{root}/bronze/weather",
        marts=f"{root}/marts",
        ledger=f"{root}/state/loads",
    )
    i = Inputs(spark, SF_SMALL)
    for mm in (1, 2):
        landing.write_trip_csv(i.bronze_trips.where((F.year("started_at") == 2024) & (F.month("started_at") == mm)), lay.landed(lay.trips_landing, 2024, mm))
        landing.write_observation_pages(i.observations, lay.landed(lay.weather_landing, 2024, mm))
    ledger = LoadLedger(spark, lay.ledger)
    ledger.record(ingest.TRIPS_PIPELINE, 2024, 1, "x")
    ledger.record(ingest.WEATHER_PIPELINE, 2024, 1, "x")
    out = backfill(spark, lay, (2024, 1), (2024, 2), check=False)
    # January is recorded as loaded but was never built, so it is built as well.
    assert list(out["loaded"]) == [(2024, 2)] and out["months"] == [(2024, 1), (2024, 2)]
    assert out["loaded"][(2024, 2)] == (ingest.LOADED, ingest.LOADED)
    assert backfill(spark, lay, (2024, 1), (2024, 2), check=False)["loaded"] == {}
    daily = build.load_marts(spark, lay)["fct_trip_daily"].collect()
    assert daily and {r.trip_date.month for r in daily} == {2}


def test_reload_with_empty_landing_clears_the_month(spark, layout):
    monthly_load(spark, layout, YEAR, MONTH, check=False)
    assert build.load_marts(spark, layout)["fct_trip_daily"].count() > 0
    empty_landing = layout.landed(layout.trips_landing, YEAR, MONTH) + "/empty"
    import os

    os.makedirs(empty_landing.replace("file:", ""), exist_ok=True)
    header = ",".join(Inputs(spark, SF_SMALL).bronze_trips.columns)
    # the reload's landing now holds only a header-only file
    reload_lay = ingest.Layout(**{**layout.__dict__, "trips_landing": layout.trips_landing + "_reload"})
    target = reload_lay.landed(reload_lay.trips_landing, YEAR, MONTH).replace("file:", "")
    os.makedirs(target, exist_ok=True)
    with open(f"{target}/empty.csv", "w", encoding="utf-8") as fh:
        fh.write(header + "\n")
    out = monthly_load(spark, reload_lay, YEAR, MONTH, force=True, check=False)
    assert out["trips"] == ingest.LOADED and (YEAR, MONTH) in out["months"]
    assert read_bronze_trips(spark, layout.trips_bronze).count() == 0
    assert all(df.count() == 0 for name, df in build.load_marts(spark, layout).items() if name != "fct_trip_daily_enriched")


def test_command_line_parses_and_runs(spark, layout):
    from velomart import __main__ as cli

    args = cli.parse(["monthly", "--root", "/shared/x", "--year", "2024", "--month", "3", "--force"])
    lay = cli._layout(args)
    assert (args.year, args.month, args.force) == (2024, 3, True)
    assert lay.trips_bronze == "/shared/x/bronze/trips" and lay.ledger == "/shared/x/state/loads"
    fill = cli.parse(["backfill", "--root", "/r", "--first", "2025-04", "--last", "2026-04"])
    assert (fill.first, fill.last) == ((2025, 4), (2026, 4))
    argv = ["monthly", "--root", "/unused", "--no-check", "--year", str(YEAR), "--month", str(MONTH)]
    for key, value in layout.__dict__.items():
        if value is not None:
            argv += [f"--{key.replace('_', '-')}", value]
    assert cli.main(argv) == 0
    assert build.load_marts(spark, layout)["fct_trip_daily"].count() > 0


def test_refresh_gate_checks_like_a_full_build(spark, scratch):
    """A refresh of April must fail on what a full build fails on: a ride id
    already used in March, and a trip with no start time (it has no month)."""
    i = Inputs(spark, SF_SMALL)
    clean = i.bronze_trips.where("year(started_at) = 2024").where("member_casual IN ('member', 'casual')").dropna()
    march = clean.where(F.month("started_at") == 3)
    april = clean.where(F.month("started_at") == 4)
    reused = march.limit(1).withColumn("started_at", F.col("started_at") + F.expr("INTERVAL 40 DAYS"))
    reused = reused.withColumn("ended_at", F.col("ended_at") + F.expr("INTERVAL 40 DAYS"))
    no_start = april.limit(1).withColumn("ride_id", F.lit("no-start")).withColumn("started_at", F.lit(None))

    def deploy(name, april_rows):
        root = scratch(name)
        lay = ingest.Layout(
            trips_landing=f"{root}/landing/trips",
            weather_landing=f"{root}/landing/weather",
            trips_bronze=f"{root}/bronze/trips",
            weather_bronze=f"{root}/bronze/weather",
            marts=f"{root}/marts",
            ledger=f"{root}/state/loads",
        )
        landing.write_trip_csv(march, lay.landed(lay.trips_landing, 2024, 3))
        landing.write_trip_csv(april_rows, lay.landed(lay.trips_landing, 2024, 4))
        for mm in (3, 4):
            landing.write_observation_pages(i.observations, lay.landed(lay.weather_landing, 2024, mm))
        assert monthly_load(spark, lay, 2024, 3)["months"] == [(2024, 3)]
        return lay

    ok = deploy("gate-ok", april)
    assert monthly_load(spark, ok, 2024, 4)["months"] == [(2024, 4)]

    shared = deploy("gate-shared", april.unionByName(reused))
    with pytest.raises(DataQualityError) as err:
        monthly_load(spark, shared, 2024, 4)
    assert "stg_trips.ride_id unique: 1 failures" in str(err.value)

    missing = deploy("gate-null", april.unionByName(no_start))
    with pytest.raises(DataQualityError, match="stg_trips.started_at not_null: 1 failures"):
        monthly_load(spark, missing, 2024, 4)


def _deployment(spark, scratch, name, months=(1, 2), change=lambda df: df):
    root = scratch(name)
    lay = ingest.Layout(
        trips_landing=f"{root}/landing/trips",
        weather_landing=f"{root}/landing/weather",
        trips_bronze=f"{root}/bronze/trips",
        weather_bronze=f"{root}/bronze/weather",
        marts=f"{root}/marts",
        ledger=f"{root}/state/loads",
    )
    i = Inputs(spark, SF_SMALL)
    for mm in months:
        landing.write_trip_csv(change(i.bronze_trips.where((F.year("started_at") == 2024) & (F.month("started_at") == mm))), lay.landed(lay.trips_landing, 2024, mm))
        landing.write_observation_pages(i.observations, lay.landed(lay.weather_landing, 2024, mm))
    return lay


def _append_bad_line(spark, lay, month):
    folder = lay.landed(lay.trips_landing, 2024, month).replace("file:", "")
    with open(f"{folder}/bad.csv", "w", encoding="utf-8") as fh:
        columns = Inputs(spark, SF_SMALL).bronze_trips.columns
        fh.write(",".join(columns) + "\n" + ",".join("not a time" if c == "started_at" else "" for c in columns) + "\n")
    return f"{folder}/bad.csv"


def test_failed_reload_leaves_the_month(spark, scratch):
    import os

    lay = _deployment(spark, scratch, "bad-reload", (3,))
    monthly_load(spark, lay, 2024, 3, check=False)
    before = sorted(map(str, read_bronze_trips(spark, lay.trips_bronze).collect()))
    bad = _append_bad_line(spark, lay, 3)
    with pytest.raises(Exception, match="not a time|CAST_INVALID_INPUT"):
        monthly_load(spark, lay, 2024, 3, force=True, check=False)
    assert sorted(map(str, read_bronze_trips(spark, lay.trips_bronze).collect())) == before
    os.remove(bad)
    assert monthly_load(spark, lay, 2024, 3, force=True, check=False)["trips"] == ingest.LOADED
    assert sorted(map(str, read_bronze_trips(spark, lay.trips_bronze).collect())) == before


def test_uncommitted_folder_is_not_loaded_and_replacement_recovers(spark, scratch):
    from velomart.sources.replace import Folder
    from velomart.sources.tables import month_partition, path_exists

    root = scratch("swap")
    target = month_partition(root, 2024, 3)
    spark.range(3).write.parquet(target)
    folder = Folder(spark, target)
    assert path_exists(spark, target)
    # A driver lost between the two renames: the old rows wait under a hidden name.
    folder.move(target, f"{folder.parent}/_last-{folder.name}")
    assert path_exists(spark, target) and spark.read.parquet(target).count() == 3
    folder.delete(f"{target}/_SUCCESS")
    assert not path_exists(spark, target)


def test_refresh_removes_months_that_a_mart_has_no_rows_for(spark, scratch):
    lay = _deployment(spark, scratch, "stale-mart", (1, 2))
    monthly_load(spark, lay, 2024, 1, check=False)
    monthly_load(spark, lay, 2024, 2, check=False)
    assert build.load_marts(spark, lay)["fct_station_flows_daily"].where("month(trip_date) = 2").count() > 0
    i = Inputs(spark, SF_SMALL)
    without = i.bronze_trips.where("year(started_at) = 2024 and month(started_at) = 2").withColumn("end_lat", F.lit(None).cast("double"))
    landing.write_trip_csv(without, lay.landed(lay.trips_landing, 2024, 2))
    assert monthly_load(spark, lay, 2024, 2, force=True, check=False)["months"] == [(2024, 2)]
    full = ingest.Layout(**{**lay.__dict__, "marts": lay.marts + "_full"})
    build.build_marts(spark, full, check=False)
    for name, df in build.load_marts(spark, lay).items():
        want = build.load_marts(spark, full)[name]
        assert sorted(map(str, df.collect())) == sorted(map(str, want.collect())), name


def test_backfill_builds_what_an_earlier_run_left(spark, scratch):
    import os

    from velomart.plans.monthly import backfill

    lay = _deployment(spark, scratch, "no-weather", (1, 2))
    weather = lay.landed(lay.weather_landing, 2024, 2).replace("file:", "")
    os.rename(weather, weather + "-later")
    with pytest.raises(Exception, match="PATH_NOT_FOUND|no weather"):
        backfill(spark, lay, (2024, 1), (2024, 2), check=False)
    os.rename(weather + "-later", weather)
    out = backfill(spark, lay, (2024, 1), (2024, 2), check=False)
    assert out["months"] == [(2024, 1), (2024, 2)]
    daily = build.load_marts(spark, lay)["fct_trip_daily"].collect()
    assert {r.trip_date.month for r in daily} == {1, 2}
    assert backfill(spark, lay, (2024, 1), (2024, 2), check=False) == {"loaded": {}, "months": [], "marts": {}}


def test_backfill_builds_again_after_a_failed_gate(spark, scratch):
    from velomart.plans.monthly import backfill

    lay = _deployment(spark, scratch, "gate", (1,), lambda df: df.union(df.limit(1)))
    for _ in range(2):
        with pytest.raises(DataQualityError):
            backfill(spark, lay, (2024, 1), (2024, 1))
    assert backfill(spark, lay, (2024, 1), (2024, 1), check=False)["months"] == [(2024, 1)]
    assert build.load_marts(spark, lay)["fct_trip_daily"].count() > 0


def _same_as_full_build(spark, lay):
    full = ingest.Layout(**{**lay.__dict__, "marts": lay.marts + "_full"})
    build.build_marts(spark, full, check=False)
    for name, df in build.load_marts(spark, lay).items():
        assert sorted(map(str, df.collect())) == sorted(map(str, build.load_marts(spark, full)[name].collect())), name


@pytest.mark.parametrize("again", [2, 1])
def test_refresh_after_a_load_lost_before_its_record(spark, scratch, monkeypatch, again):
    """The driver is lost between the write of February and its ledger row."""
    lay = _deployment(spark, scratch, f"lost-{again}", (1, 2))
    monthly_load(spark, lay, 2024, 1, check=False)
    with monkeypatch.context() as m:
        m.setattr(LoadLedger, "record", lambda *a, **k: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            monthly_load(spark, lay, 2024, 2, check=False)
    out = monthly_load(spark, lay, 2024, again, check=False)
    assert (2024, 2) in out["months"]
    ledger = LoadLedger(spark, lay.ledger)
    assert ledger.already_loaded(ingest.TRIPS_PIPELINE, 2024, 2) == (again == 2)
    assert build.load_marts(spark, lay)["fct_trip_daily"].where("month(trip_date) = 2").count() > 0
    _same_as_full_build(spark, lay)


def test_a_lost_reload_leaves_no_old_span(spark, scratch, monkeypatch):
    """January's forced reload brings trips of February too and is lost before its record."""
    from velomart.plans import monthly

    lay = _deployment(spark, scratch, "lost-reload", (1,))
    ledger = LoadLedger(spark, lay.ledger)
    monthly._load(spark, lay, ledger, 2024, 1, False, None)
    assert monthly._landed_with(spark, lay, ledger, {(2024, 2)}) == []
    trips = Inputs(spark, SF_SMALL).bronze_trips.where("year(started_at) = 2024 and month(started_at) < 3")
    landing.write_trip_csv(trips, lay.landed(lay.trips_landing, 2024, 1))
    with monkeypatch.context() as m:
        m.setattr(LoadLedger, "record", lambda *a, **k: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            monthly._load(spark, lay, ledger, 2024, 1, True, None)
    assert monthly._landed_with(spark, lay, ledger, {(2024, 2)}) is None
    assert monthly._load(spark, lay, ledger, 2024, 1, False, None)[0] == ingest.SKIPPED_EXISTS
    assert monthly._landed_with(spark, lay, ledger, {(2024, 2)}) == [(2024, 1)]
