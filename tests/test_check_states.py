"""Stored check results: equal to checks over whole tables, and what a refresh reads."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from velomart.catalog import Inputs
from velomart.operators import quality
from velomart.operators.staging import stage_trips, stage_weather
from velomart.operators.weather import pivot_observations
from velomart.plans import build, check_states, ingest
from velomart.sources.replace import Folder
from velomart.sources.seed import read_holidays
from velomart.sources.tables import read_bronze_trips, read_bronze_weather, write_bronze

from tables_at import SF_SMALL

MONTHS = [(2024, 2), (2024, 3), (2024, 4)]


def _month(year, month):
    return (F.year("started_at") == year) & (F.month("started_at") == month)


@pytest.fixture()
def layout(spark, scratch):
    root = scratch("checked")
    names = ("trips_landing", "weather_landing", "trips_bronze", "weather_bronze", "marts", "ledger")
    lay = ingest.Layout(**{n: f"{root}/{n}" for n in names}, key_buckets=4)
    i = Inputs(spark, SF_SMALL)
    for year, month in MONTHS:
        write_bronze(i.bronze_trips.where(_month(year, month)), lay.trips_bronze, year, month)
    spring = i.observations.where("year(obs_date) = 2024 and month(obs_date) in (2, 3)")
    write_bronze(pivot_observations(spring), lay.weather_bronze, date_col="weather_date")
    return lay


def _report(rows):
    return {(r.table_name, r.column_name, r.check_name): r.failures for r in rows}


def _whole(spark, lay, tables=("stg_trips", "stg_weather_daily")):
    found = {
        "stg_trips": stage_trips(read_bronze_trips(spark, lay.trips_bronze)),
        "stg_weather_daily": stage_weather(read_bronze_weather(spark, lay.weather_bronze)),
        "holiday_calendar": read_holidays(spark, lay.seed),
    }
    if len(tables) > 2:
        found.update(build.load_marts(spark, lay))
    return _report(quality.collect_check_results(found, quality.checks_for(found)))


def _staged(spark, lay):
    return _report(check_states.refresh_report(spark, lay, check_states.stored_tables(spark, lay)).collect())


def _read_parts(monkeypatch):
    """What refreshes read from the tables' folders and from which buckets of kept keys."""
    seen = {"folders": [], "buckets": [], "kept": []}
    rows_of, kept_keys = check_states.CheckStates._rows_of, check_states.CheckStates.kept_keys

    def rows(self, now, labels):
        df = rows_of(self, now, labels)
        seen["folders"].append((self.table.name, sorted(labels), df._jdf.queryExecution().executedPlan().toString()))
        return df

    def keys(self, labels, buckets):
        df = kept_keys(self, labels, buckets)
        seen["buckets"].append((self.table.name, buckets))
        seen["kept"].append(df)
        return df

    monkeypatch.setattr(check_states.CheckStates, "_rows_of", rows)
    monkeypatch.setattr(check_states.CheckStates, "kept_keys", keys)
    return seen


def test_changes_of_months_keep_the_report_of_the_whole(spark, layout):
    i = Inputs(spark, SF_SMALL)
    march = i.bronze_trips.where(_month(2024, 3))
    assert _staged(spark, layout) == _whole(spark, layout)
    id_check = ("stg_trips", "ride_id", quality.UNIQUE)
    assert _staged(spark, layout)[id_check] == 0
    # Rides of March again in April (three), one of them twice more; nulls and odd riders.
    april = i.bronze_trips.where(_month(2024, 4))
    again = march.orderBy("ride_id").limit(3)
    write_bronze(april.unionByName(again).unionByName(again.limit(1)).unionByName(april.limit(2).withColumn("ride_id", F.lit(None).cast("string"))), layout.trips_bronze, 2024, 4)
    assert _staged(spark, layout) == _whole(spark, layout)
    assert _staged(spark, layout)[id_check] == 3
    # The other side of a repeat goes: what is left repeats within April alone.
    ids = [r.ride_id for r in again.select("ride_id").collect()]
    write_bronze(march.where(~F.col("ride_id").isin(*ids)), layout.trips_bronze, 2024, 3)
    assert _staged(spark, layout) == _whole(spark, layout)
    assert _staged(spark, layout)[id_check] <= 1
    # An emptied month, a month that is gone and one that comes.
    write_bronze(march.limit(0), layout.trips_bronze, 2024, 3)
    Folder(spark, f"{layout.trips_bronze}/year=2024/month=02").remove()
    write_bronze(march.withColumn("member_casual", F.lit("guest")), layout.trips_bronze, 2024, 5)
    assert _staged(spark, layout) == _whole(spark, layout)
    assert _staged(spark, layout)[("stg_trips", "member_casual", quality.ACCEPTED_VALUES)] == 2


def test_rows_without_a_month_and_no_rows(spark, layout):
    i = Inputs(spark, SF_SMALL)
    lost = i.bronze_trips.limit(5).withColumn("started_at", F.lit(None).cast("timestamp_ntz"))
    write_bronze(lost, layout.trips_bronze)  # the folder of nulls
    assert _staged(spark, layout) == _whole(spark, layout)
    assert _staged(spark, layout)[("stg_trips", "started_at", quality.NOT_NULL)] == 5
    empty = replace(layout, trips_bronze=f"{layout.trips_bronze}-none", marts=f"{layout.marts}-none")
    write_bronze(i.bronze_trips.limit(0), empty.trips_bronze, 2024, 1)
    assert _staged(spark, empty) == _whole(spark, empty)


def test_a_refresh_reads_changed_folders_and_touched_buckets(spark, layout, monkeypatch):
    _staged(spark, layout)
    seen = _read_parts(monkeypatch)
    _staged(spark, layout)
    assert seen["folders"] == [] and seen["buckets"] == []
    one = Inputs(spark, SF_SMALL).bronze_trips.where(_month(2024, 3)).withColumn("rideable_type", F.lit("other"))
    write_bronze(one, layout.trips_bronze, 2024, 3)  # other rows with the ids of before
    _staged(spark, layout)
    assert {(t, *labels) for t, labels, _ in seen["folders"]} == {("stg_trips", "2024-3")}
    for _, _, plan in seen["folders"]:
        filters = plan[plan.index("PartitionFilters"):].split("]")[0]
        assert "year" in filters and "month" in filters
    assert [b for _, b in seen["buckets"]] == [[]]
    new = one.limit(1).withColumn("ride_id", F.lit("another"))
    write_bronze(one.unionByName(new), layout.trips_bronze, 2024, 3)
    _staged(spark, layout)
    (bucket,) = seen["buckets"][-1][1]
    plan = seen["kept"][-1]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan and f"(bucket#" in plan and f"= {bucket})" in plan
    assert _staged(spark, layout) == _whole(spark, layout)


def test_a_run_stopped_between_keys_and_repeats(spark, layout, monkeypatch):
    i = Inputs(spark, SF_SMALL)
    _staged(spark, layout)
    march = i.bronze_trips.where(_month(2024, 3))
    april = i.bronze_trips.where(_month(2024, 4))
    write_bronze(april.unionByName(march.limit(2)), layout.trips_bronze, 2024, 4)
    replace_by = Folder.replace_by

    def stop(self, written):
        if self.name == "repeats" and "stg_trips" in self.path:
            raise OSError("driver lost")
        replace_by(self, written)

    with monkeypatch.context() as m:
        m.setattr(Folder, "replace_by", stop)
        with pytest.raises(OSError):
            _staged(spark, layout)
    assert _staged(spark, layout) == _whole(spark, layout)
    assert _staged(spark, layout)[("stg_trips", "ride_id", quality.UNIQUE)] == 2


def test_report_over_marts_after_a_refresh(spark, layout, monkeypatch):
    build.build_marts(spark, layout, check=False)
    assert _report(build.stored_report(spark, layout).collect()) == _whole(spark, layout, build.MART_ORDER)
    i = Inputs(spark, SF_SMALL)
    march = i.bronze_trips.where(_month(2024, 3))
    write_bronze(march.unionByName(march.where("ride_id LIKE '%7'")), layout.trips_bronze, 2024, 3)
    build.build_marts(spark, layout, check=False, months=[(2024, 3)])
    seen = _read_parts(monkeypatch)
    report = _report(build.stored_report(spark, layout).collect())
    assert report == _whole(spark, layout, build.MART_ORDER) and len(report) == 59
    assert report[("fct_trips", "ride_id", quality.UNIQUE)] > 0
    assert {label for _, labels, _ in seen["folders"] for label in labels} == {"2024-3", "2024-03-01"}
