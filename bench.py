"""Benchmark: ingest -> build marts -> quality report -> report queries.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_EVENTLOG (optional folder for Spark's event log; summarise it with
``tools/stage_times.py``).
Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.

The timed work is what a deployment runs: trip and weather rows (derived from
the shared tables by the fixture recipe) are written to month-partitioned
bronze, the seven marts are rebuilt from bronze, the declared checks run over
the stored marts, and the report queries read the stored marts.  Session start
(JVM launch) is not timed; every query is timed to its last row.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from velomart.catalog import SAMPLE_DAYS, SAMPLE_HOURS, Inputs  # noqa: E402
from velomart.operators import quality, reports  # noqa: E402
from velomart.operators.staging import stage_trips, stage_weather  # noqa: E402
from velomart.operators.weather import pivot_observations  # noqa: E402
from velomart.plans.build import build_marts, load_marts  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from velomart.plans.ingest import Layout, ingest_trips_month  # noqa: E402
from velomart.plans.ledger import LoadLedger  # noqa: E402
from velomart.sources.landing import write_trip_csv  # noqa: E402
from velomart.session import build_session, clear_scratch, scratch_path  # noqa: E402
from velomart.sources.seed import read_holidays  # noqa: E402
from velomart.sources.tables import read_bronze_trips, read_bronze_weather, write_bronze  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    extra = {"spark.driver.memory": "16g", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m"}
    event_dir = os.environ.get("BENCH_EVENTLOG")  # a folder: write Spark's event log there
    if event_dir:
        os.makedirs(event_dir, exist_ok=True)
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_dir})
    spark = build_session(f"local[{cpus}]", app_name="velomart-bench", shuffle_partitions=cpus * 2, extra_conf=extra)
    root = scratch_path(spark, "bench")
    layout = Layout(
        trips_landing=f"{root}/landing/trips",
        weather_landing=f"{root}/landing/weather",
        trips_bronze=f"{root}/bronze/trips",
        weather_bronze=f"{root}/bronze/weather",
        marts=f"{root}/marts",
        ledger=f"{root}/state/pipeline_loads",
    )
    timings: dict[str, float] = {}
    rows: dict[str, int] = {}

    # Generic JVM warm-up on synthetic rows (not the benchmark inputs): class
    # loading and JIT of the shuffle, aggregation and parquet paths.  Reported
    # separately, not part of the total.
    t0 = time.perf_counter()
    warm = f"{root}/warmup"
    spark.range(200_000).selectExpr("id % 97 AS k", "id AS v").groupBy("k").sum("v").write.parquet(warm)
    spark.read.parquet(warm).agg({"k": "max"}).collect()
    warmup_sec = round(time.perf_counter() - t0, 3)

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        timings[name] = round(time.perf_counter() - t0, 3)
        if isinstance(out, int):
            rows[name] = out
        return out

    inputs = Inputs(spark, sf_dir)

    # 1. bronze: one write per table, partitioned by month
    timed("ingest_trips_bronze", lambda: write_bronze(inputs.bronze_trips, layout.trips_bronze))
    timed(
        "ingest_weather_bronze",
        lambda: write_bronze(pivot_observations(inputs.observations), layout.weather_bronze, date_col="weather_date"),
    )

    # 1b. the landed-CSV path of a monthly load (separate folders): header-aware
    # scan of two CSV layouts, ANSI casts, month partition write, ledger record
    csv_layout = Layout(
        trips_landing=f"{root}/csv/landing/trips",
        weather_landing=f"{root}/csv/landing/weather",
        trips_bronze=f"{root}/csv/bronze/trips",
        weather_bronze=f"{root}/csv/bronze/weather",
        marts=f"{root}/csv/marts",
        ledger=f"{root}/csv/state/loads",
    )
    landed = csv_layout.landed(csv_layout.trips_landing, 2024, 6)
    early = F.month("started_at") <= 6
    write_trip_csv(inputs.bronze_trips.where(early), f"{landed}/part_a")
    write_trip_csv(inputs.bronze_trips.where(~early), f"{landed}/part_b", list(reversed(inputs.bronze_trips.columns)))
    timed(
        "ingest_csv_month",
        lambda: ingest_trips_month(spark, csv_layout, LoadLedger(spark, csv_layout.ledger), 2024, 6),
    )

    # 2. marts (full rebuild from bronze); checks are timed separately below
    timed("build_marts", lambda: build_marts(spark, layout, check=False))
    # the monthly path: recompute one trip month and replace only its folders
    timed("refresh_one_month", lambda: build_marts(spark, layout, check=False, months=[(2024, 6)]))
    m = load_marts(spark, layout)
    tables = {
        "fct_trips": m["fct_trips"],
        "fct_trip_daily": m["fct_trip_daily"],
        "fct_trip_daily_enriched": m["fct_trip_daily_enriched"],
        "fct_station_daily": m["fct_station_daily"],
        "fct_station_flows_daily": m["fct_station_flows_daily"],
        "fct_station_hourly": m["fct_station_hourly"],
        "fct_station_flows_hourly": m["fct_station_flows_hourly"],
        "stg_trips": stage_trips(read_bronze_trips(spark, layout.trips_bronze)),
        "stg_weather_daily": stage_weather(read_bronze_weather(spark, layout.weather_bronze)),
        "holiday_calendar": read_holidays(spark),
    }
    timed("quality_report", lambda: len(quality.collect_check_results(tables)))

    # 3. reports over the stored marts
    enriched = m["fct_trip_daily_enriched"]
    days = reports.filter_days(enriched)
    some_days = reports.filter_days(enriched, SAMPLE_DAYS)
    hourly_sel = reports.selected_station_hours(m["fct_station_hourly"], days)
    report_queries = {
        "kpis": lambda: reports.kpis(days),
        "weekday_profile": lambda: reports.weekday_profile(days),
        "top_days": lambda: reports.top_days(days),
        "top_flows_daily": lambda: reports.top_flows_daily(m["fct_station_flows_daily"], days),
        "top_flows_daily_filtered": lambda: reports.top_flows_daily(m["fct_station_flows_daily"], some_days),
        "top_flows_hourly": lambda: reports.top_flows_hourly(m["fct_station_flows_hourly"], days, SAMPLE_HOURS),
        "station_activity_daily": lambda: reports.map_stations(
            reports.station_activity_daily(m["fct_station_daily"], days)
        ),
        "station_activity_hourly": lambda: reports.map_stations(
            reports.station_activity_hourly(m["fct_station_hourly"], some_days, SAMPLE_HOURS)
        ),
        "hourly_trips": lambda: reports.hourly_trips(hourly_sel),
        "hourly_rider_mix": lambda: reports.hourly_rider_mix(hourly_sel),
        "bucket_trips": lambda: reports.bucket_trips(hourly_sel),
        "hourly_leaders": lambda: reports.hourly_leaders(hourly_sel),
    }
    for name, build in report_queries.items():
        timed(name, lambda b=build: len(b().collect()))

    total = round(sum(timings.values()), 3)
    sf_match = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "end_to_end_wall_sec",
                "value": total,
                "unit": "sec",
                "queries": timings,
                "rows": rows,
                "sf": float(sf_match.group(1)) if sf_match else sf_dir,
                "cpus": cpus,
                "warmup_sec": warmup_sec,
                "spark": spark.version,
            }
        )
    )
    # The bench deployment (bronze, marts, ledger) is not needed after timing.
    clear_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
