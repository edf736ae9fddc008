"""Plan-shape tests: the physical plans keep the properties the design relies on."""

import contextlib
import io

import pytest

from velomart.catalog import SAMPLE_DAYS, Inputs
from velomart.operators import marts, reports
from velomart.operators.staging import stage_trips
from velomart.operators.weather import pivot_observations
from velomart.plans import build, ingest
from velomart.sources.tables import read_bronze, write_bronze

from tables_at import SF_SMALL


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def stored(spark):
    from velomart.session import scratch_path

    root = scratch_path(spark, "plans")
    lay = ingest.Layout("l1", "l2", f"{root}/bt", f"{root}/bw", f"{root}/marts", f"{root}/ledger")
    i = Inputs(spark, SF_SMALL)
    write_bronze(i.bronze_trips, lay.trips_bronze)
    write_bronze(pivot_observations(i.observations), lay.weather_bronze, date_col="weather_date")
    build.build_marts(spark, lay, check=False)
    return lay


def test_mart_aggregates_partially_before_one_shuffle(spark, stored):
    staged = stage_trips(read_bronze(spark, stored.trips_bronze))
    p = plan(marts.flows_hourly(staged))
    assert p.count("+- Exchange (") == 1  # one shuffle per mart (tree nodes only)
    assert "partial_count" in p and "partial_avg" in p  # map-side combine absorbs hot keys
    assert "PushedFilters: [IsNotNull(start_station_id), IsNotNull(end_station_id)" in p
    read_schema = [ln for ln in p.splitlines() if ln.startswith("ReadSchema")][0]
    assert "ride_id" not in read_schema and "rideable_type" not in read_schema and "ended_at" not in read_schema
    # bucket / rush labels are computed after the aggregation, not shuffled
    exchange = [ln for ln in p.splitlines() if "hashpartitioning(" in ln][0]
    assert "hour_bucket" not in exchange and "is_rush_hour" not in exchange


def test_month_refresh_pushes_started_at_range(spark, stored):
    staged = stage_trips(read_bronze(spark, stored.trips_bronze)).where(
        build.in_months("started_at", [(2024, 3)], as_timestamp=True)
    )
    p = plan(marts.station_daily(staged))
    assert "GreaterThanOrEqual(started_at,2024-03-01T00:00)" in p and "LessThan(started_at,2024-04-01T00:00)" in p


def test_day_selection_prunes_month_folders(spark, stored):
    m = build.load_marts(spark, stored)
    days = reports.filter_days(m["fct_trip_daily_enriched"], SAMPLE_DAYS)
    df = reports.top_flows_daily(m["fct_station_flows_daily"], days)
    df.collect()
    p = plan(df)
    assert "dynamicpruningexpression(trip_month" in p
    assert "BroadcastHashJoin LeftSemi" in p
    assert "TakeOrderedAndProject" in p


def test_schemas_of_marts_run_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("schemas", "schemas")
    build.mart_schemas(spark)
    assert not tracker.getJobIdsForGroup("schemas")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_reports_use_no_python_udf(spark, stored):
    m = build.load_marts(spark, stored)
    days = reports.filter_days(m["fct_trip_daily_enriched"])
    frames = [
        reports.kpis(days),
        reports.weekday_profile(days),
        reports.top_flows_hourly(m["fct_station_flows_hourly"], days),
        reports.hourly_rider_mix(reports.selected_station_hours(m["fct_station_hourly"], days)),
        marts.daily_enriched(m["fct_trip_daily"], spark.read.parquet(stored.weather_bronze), Inputs(spark, SF_SMALL).holidays),
    ]
    for df in frames:
        p = plan(df)
        assert "PythonUDF" not in p and "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_refresh_prunes_landed_months(spark, stored):
    from velomart.operators.staging import stage_trips
    from velomart.sources.tables import read_bronze_trips

    bronze = read_bronze_trips(spark, stored.trips_bronze).where(build._landed_in([(2024, 3)]))
    text = plan(stage_trips(bronze).where(build.in_months("started_at", [(2024, 3)], as_timestamp=True)))
    scan = text[text.index("PartitionFilters"):].split("]")[0]
    assert "year" in scan and "month" in scan
