"""Write PLANS.md: physical plan trees and scan details of the key jobs.

Usage: python tools/plan_report.py [sf_dir]   (default /root/testdata/sf0.01)
Builds bronze and marts in a scratch folder, then records the formatted plan
tree plus each scan's location-independent details.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from velomart.catalog import SAMPLE_DAYS, SAMPLE_HOURS, Inputs  # noqa: E402
from velomart.operators import marts, quality, reports  # noqa: E402
from velomart.operators.joins import TRIP_MONTH, with_trip_month  # noqa: E402
from velomart.operators.staging import stage_trips, stage_weather  # noqa: E402
from velomart.operators.weather import pivot_observations  # noqa: E402
from velomart.plans import build, ingest  # noqa: E402
from velomart.session import build_session, scratch_path  # noqa: E402
from velomart.sources.tables import read_bronze, read_bronze_weather, write_bronze  # noqa: E402

CORES = 2


def formatted(df, run: bool) -> str:
    if run:
        df.collect()  # final adaptive plan
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    tree = text.split("\n\n\n")[0]
    details = [
        ln
        for ln in text.splitlines()
        if ln.startswith(("PushedFilters", "PartitionFilters", "ReadSchema", "Join type", "Keys [", "Functions ["))
    ]
    text = tree + "\n\n" + "\n".join(details)
    text = re.sub(r"#\d+L?", "", text)
    return re.sub(r"file:[^\],]+", "<path>", text)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(f"local[{CORES}]", shuffle_partitions=8)
    root = scratch_path(spark, "plan-report")
    lay = ingest.Layout("l1", "l2", f"{root}/bt", f"{root}/bw", f"{root}/marts", f"{root}/ledger")
    i = Inputs(spark, sf_dir)
    write_bronze(i.bronze_trips, lay.trips_bronze)
    write_bronze(pivot_observations(i.observations), lay.weather_bronze, date_col="weather_date")
    build.build_marts(spark, lay, check=False)
    m = build.load_marts(spark, lay)
    staged = stage_trips(read_bronze(spark, lay.trips_bronze))
    weather = stage_weather(read_bronze_weather(spark, lay.weather_bronze))
    days = reports.filter_days(m["fct_trip_daily_enriched"], SAMPLE_DAYS)
    march = build.in_months("started_at", [(2024, 3)], as_timestamp=True)
    landed = read_bronze(spark, lay.trips_bronze).where(build._landed_in([(2024, 3)]))
    refresh = stage_trips(landed).where(march)
    ride_unique = [c for c in quality.checks_for(["stg_trips"]) if c.kind == quality.UNIQUE]
    cases = [
        ("Mart: hourly OD flows from bronze (full rebuild)", marts.flows_hourly(staged), False),
        ("Mart: station daily, refresh of one month", marts.station_daily(refresh), False),
        ("Mart: enriched days from stored daily facts", marts.daily_enriched(m["fct_trip_daily"], weather, i.holidays), False),
        ("Report: top daily flows over filtered days (stored marts)", reports.top_flows_daily(m["fct_station_flows_daily"], days), True),
        ("Report: top hourly flows with hour filters", reports.top_flows_hourly(m["fct_station_flows_hourly"], days, SAMPLE_HOURS), True),
        ("Write: CSV export of the day frame (one output task after the joins)", days.repartition(1), False),
        ("Write: trip facts of a refresh, sorted by month and day without an exchange",
         with_trip_month(marts.trip_facts(refresh)).sortWithinPartitions(TRIP_MONTH, *marts.mart_sort_keys("fct_trips")), False),
        ("Report: KPIs", reports.kpis(reports.filter_days(m["fct_trip_daily_enriched"])), True),
        ("Check: not-null + unique + accepted values on hourly station facts",
         quality.check_results({"fct_station_hourly": m["fct_station_hourly"]}, quality.checks_for(["fct_station_hourly"])), False),
        ("Check: ride_id unique in a one-month refresh, against all other months",
         quality.check_results({"stg_trips": staged.where(march | staged.started_at.isNull())}, ride_unique,
                               rest={"stg_trips": staged.where(~march)}), False),
    ]
    out = [
        "# Physical plans (generated by `tools/plan_report.py`)\n",
        f"Data: `{sf_dir}`, local[{CORES}], AQE on. Expression ids and paths removed. Report plans are",
        "the final adaptive plans after running; mart and check plans are the initial plans.\n",
    ]
    for title, df, run in cases:
        out.append(f"## {title}\n\n```\n{formatted(df, run)}\n```\n")
    with open(os.path.join(ROOT, "PLANS.md"), "w", encoding="utf-8") as fh:
        fh.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
