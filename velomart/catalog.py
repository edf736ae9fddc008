"""Registered queries over the shared test tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame.  Inputs are the
trip-, weather- and ledger-shaped relations that Spark derives from the shared
tables (``velomart.sources.fixtures``), so every query's work grows with them.
Round-trip queries write through the real sinks into a fresh folder under the
shared checkpoint folder and read the result back.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velomart.functions.calendar import DAY_NAMES, MONTH_NAMES
from velomart.functions.daypart import HOUR_BUCKETS
from velomart.functions.time import month_window, previous_month, yyyymm, zero_pad_month
from velomart.operators import marts, quality, reports
from velomart.operators.joins import TRIP_MONTH, with_trip_month
from velomart.operators.staging import stage_trips, stage_weather
from velomart.operators.weather import pivot_observations
from velomart.plans.build import build_marts, load_marts, stored_report
from velomart.plans.ingest import TRIPS_PIPELINE, Layout
from velomart.plans.ledger import LoadLedger, pending_months
from velomart.plans.monthly import monthly_load
from velomart.plans.versions import published
from velomart.plans.views import read_ordered_mart
from velomart.session import scratch_path
from velomart.sources import fixtures, landing, tables
from velomart.sources.seed import read_holidays, write_seed_csv

# Report parameters of the registered queries.
SAMPLE_DAYS = reports.DayFilters(
    start_date="2024-02-01",
    end_date="2025-11-30",
    seasons=("Winter", "Spring", "Summer"),
    day_names=tuple(DAY_NAMES[:6]),
    years=(2024,),
    month_names=tuple(MONTH_NAMES[:8]),
    holiday=reports.NON_HOLIDAYS_ONLY,
    day_type=reports.WEEKDAYS_ONLY,
)
SAMPLE_HOURS = reports.HourFilters(
    start_hour=7,
    end_hour=22,
    hour_buckets=tuple(HOUR_BUCKETS[:3]),
    rush=reports.NON_RUSH_ONLY,
)
WEEKEND_DAYS = reports.DayFilters(
    start_date="2024-01-15",
    end_date="2025-10-31",
    seasons=("Spring", "Summer", "Fall"),
    day_names=tuple(DAY_NAMES[1:]),
    years=(2025,),
    month_names=tuple(MONTH_NAMES[2:]),
    holiday=reports.NON_HOLIDAYS_ONLY,
    day_type=reports.WEEKENDS_ONLY,
)
RUSH_HOURS = reports.HourFilters(start_hour=5, end_hour=18, rush=reports.RUSH_ONLY)
LISTED_DAYS = reports.DayFilters(dates=("2024-01-01", "2024-05-27", "2024-07-04", "2024-12-25"))
WEATHER_WINDOW = (2024, 2)
CSV_SPLIT_MONTH = 6  # trips up to June land in one CSV layout, later ones in another
EXTRA_CSV_COLUMN = "rental_access_method"

REPLACED_MONTH = (2024, 3)  # the month that comes in anew in quality_after_refresh
AVERAGE_DIGITS = 6  # averages of averages are compared at this precision


def rounded(df: DataFrame, columns: list[str], digits: int = AVERAGE_DIGITS) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


class Inputs:
    """Lazily built relations for one data folder (nothing runs until an action)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @cached_property
    def bronze_trips(self) -> DataFrame:
        return fixtures.fixture_trips(self.spark, self.sf_dir)

    def with_repeated_rides(self) -> Inputs:
        """The same relations over trips of which some are there twice."""
        other = Inputs(self.spark, self.sf_dir)
        other.__dict__["bronze_trips"] = fixtures.with_repeats(self.bronze_trips)
        return other

    @cached_property
    def staged(self) -> DataFrame:
        return stage_trips(self.bronze_trips)

    @cached_property
    def observations(self) -> DataFrame:
        return fixtures.fixture_observations(self.spark, self.sf_dir)

    @cached_property
    def weather(self) -> DataFrame:
        return stage_weather(pivot_observations(self.observations))

    @cached_property
    def holidays(self) -> DataFrame:
        return read_holidays(self.spark)

    @cached_property
    def facts(self) -> DataFrame:
        return marts.trip_facts(self.staged)

    @cached_property
    def daily(self) -> DataFrame:
        return marts.trip_daily(self.facts)

    @cached_property
    def enriched(self) -> DataFrame:
        return marts.daily_enriched(self.daily, self.weather, self.holidays)

    @cached_property
    def station_daily(self) -> DataFrame:
        return marts.station_daily(self.staged)

    @cached_property
    def station_hourly(self) -> DataFrame:
        return marts.station_hourly(self.staged)

    @cached_property
    def flows_daily(self) -> DataFrame:
        return marts.flows_daily(self.staged)

    @cached_property
    def flows_hourly(self) -> DataFrame:
        return marts.flows_hourly(self.staged)

    @cached_property
    def days(self) -> DataFrame:
        """Days selected by the default (all-inclusive) day filters."""
        return reports.filter_days(self.enriched, reports.DayFilters())

    def checked_tables(self) -> dict[str, DataFrame]:
        return {
            "stg_trips": self.staged,
            "stg_weather_daily": self.weather,
            "fct_trips": self.facts,
            "fct_trip_daily": self.daily,
            "fct_trip_daily_enriched": self.enriched,
            "fct_station_daily": self.station_daily,
            "fct_station_flows_daily": self.flows_daily,
            "fct_station_hourly": self.station_hourly,
            "fct_station_flows_hourly": self.flows_hourly,
            "holiday_calendar": self.holidays,
        }


Query = Callable[[SparkSession, str], DataFrame]


def _q(build: Callable[[Inputs], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(Inputs(spark, sf_dir))

    run.__doc__ = build.__doc__
    return run


# ---------------------------------------------------------------- round trips


def _csv_union_roundtrip(i: Inputs) -> DataFrame:
    """Land trips as CSV files with two header layouts and read them back by name; columns
    beyond the declared ones get the types that their values have."""
    root = scratch_path(i.spark, "landing-trips")
    early = F.coalesce(F.month("started_at") <= CSV_SPLIT_MONTH, F.lit(False))
    names = list(i.bronze_trips.columns)
    landing.write_trip_csv(i.bronze_trips.where(early), f"{root}/layout_a", names)
    extra = {
        EXTRA_CSV_COLUMN: F.concat(F.lit("R"), F.col("ride_id")),
        "name_length": F.length("start_station_name").cast("long"),
        "double_lat": F.col("start_lat") * 2,
        "service_day": F.to_date("started_at"),
        "is_member": F.col("member_casual") == "member",
    }
    late = i.bronze_trips.where(~early).withColumns(extra)
    landing.write_trip_csv(late, f"{root}/nested/layout_b", [*extra, *names[::-1]])
    return landing.read_trip_csvs(i.spark, root)


def _json_observations(i: Inputs) -> DataFrame:
    """Land observations as JSON pages, read them back and pivot to daily weather."""
    root = scratch_path(i.spark, "landing-weather")
    landing.write_observation_pages(i.observations, root)
    return stage_weather(pivot_observations(landing.read_observation_pages(i.spark, root)))


def _bronze_roundtrip(i: Inputs) -> DataFrame:
    """Write the month partitions twice (a rerun), read once, stage."""
    root = scratch_path(i.spark, "bronze-trips")
    tables.write_bronze(i.bronze_trips, root)
    tables.write_bronze(i.bronze_trips, root)
    return stage_trips(tables.read_bronze_trips(i.spark, root))


def _ledger_roundtrip(i: Inputs) -> DataFrame:
    ledger = LoadLedger(i.spark, scratch_path(i.spark, "ledger"))
    ledger.append(fixtures.fixture_ledger(i.spark, i.sf_dir))
    return ledger.read()


def _ledger_compacted(i: Inputs) -> DataFrame:
    """The ledger after many appends, with compactions in between."""
    ledger = LoadLedger(i.spark, scratch_path(i.spark, "ledger"))
    loads = fixtures.fixture_ledger(i.spark, i.sf_dir)
    for month in range(1, 13):
        ledger.append(loads.where(F.col("month") == month).coalesce(1))
        ledger.compact(max_files=3)
    return ledger.read()


def _ledger_lookup(i: Inputs) -> DataFrame:
    """Which requested months the ledger has loads of, and how many."""
    ledger = LoadLedger(i.spark, scratch_path(i.spark, "ledger"))
    ledger.append(fixtures.fixture_ledger(i.spark, i.sf_dir))
    return ledger.load_counts(fixtures.fixture_requested_months(i.spark, i.sf_dir))


def _monthly_load_marts(i: Inputs) -> DataFrame:
    """Two monthly runs over landed files, a rerun that skips and a forced reload, with
    all checks on: the enriched days, the staged weather and the loads of each month.

    Trips that the checks refuse (incomplete or of an unknown rider) are not landed.
    """
    root = scratch_path(i.spark, "monthly")
    names = ("trips_landing", "weather_landing", "trips_bronze", "weather_bronze", "marts", "ledger")
    layout = Layout(**{name: f"{root}/{name}" for name in names})
    complete = i.bronze_trips.where(F.col("member_casual").isin("member", "casual")).dropna()
    runs = [(2024, 3, False), (2024, 4, False), (2024, 4, False), (2024, 4, True)]
    for year, month in sorted({(y, m) for y, m, _ in runs}):
        landed = (F.year("started_at") == year) & (F.month("started_at") == month)
        landing.write_trip_csv(complete.where(landed), layout.landed(layout.trips_landing, year, month))
        seen = (F.year("obs_date") == year) & (F.month("obs_date") == month)
        landing.write_observation_pages(i.observations.where(seen), layout.landed(layout.weather_landing, year, month))
    for year, month, force in runs:
        monthly_load(i.spark, layout, year, month, force=force)
    days = read_ordered_mart(i.spark, layout, "fct_trip_daily_enriched")
    weather = stage_weather(tables.read_bronze_weather(i.spark, layout.weather_bronze))
    weather = weather.select(F.col("weather_date").alias("day"), F.col("temperature_min_c").alias("staged_min_c"))
    requested = days.select(F.lit(TRIPS_PIPELINE).alias("pipeline_name"), F.year("trip_date").alias("year"), F.month("trip_date").alias("month")).distinct()
    loads = LoadLedger(i.spark, layout.ledger).load_counts(requested).select("year", "month", F.col("loads").alias("trip_loads"))
    return (
        days.join(weather, F.col("trip_date") == F.col("day"), "left")
        .join(loads, (F.year("trip_date") == F.col("year")) & (F.month("trip_date") == F.col("month")))
        .select(
            "trip_date", "total_trips", "member_trips", "casual_trips", "avg_trip_duration_minutes",
            "temperature_max_c", "season", "staged_min_c", "trip_loads",
        )
    )


def _quality_after_refresh(i: Inputs) -> DataFrame:
    """The report from stored check results, after one month came in anew.

    All months are loaded, built and checked, one of them without its repeated rides; then
    that month is replaced and its marts are refreshed, and the report reads its folders
    and the touched buckets of keys alone.
    """
    root = scratch_path(i.spark, "checked")
    names = ("trips_landing", "weather_landing", "trips_bronze", "weather_bronze", "marts", "ledger")
    layout = Layout(**{name: f"{root}/{name}" for name in names}, key_buckets=4)
    year, month = REPLACED_MONTH
    replaced = (F.year("started_at") == year) & (F.month("started_at") == month)
    complete = fixtures.with_repeats(i.bronze_trips)
    tables.write_bronze(complete.where(~replaced), layout.trips_bronze)
    tables.write_bronze(i.bronze_trips.where(replaced), layout.trips_bronze, year, month)
    tables.write_bronze(pivot_observations(i.observations), layout.weather_bronze, date_col="weather_date")
    build_marts(i.spark, layout, check=False)
    stored_report(i.spark, layout).collect()
    tables.write_bronze(complete.where(replaced), layout.trips_bronze, year, month)
    build_marts(i.spark, layout, check=False, months=[REPLACED_MONTH])
    return stored_report(i.spark, layout)


def _marts_by_version(i: Inputs) -> DataFrame:
    """Rows of each mart and month in two versions: all months are built, one of them comes
    in anew without its casual rides, and its marts are refreshed; both versions are read."""
    root = scratch_path(i.spark, "versions")
    names = ("trips_landing", "weather_landing", "trips_bronze", "weather_bronze", "marts", "ledger")
    layout = Layout(**{name: f"{root}/{name}" for name in names})
    year, month = REPLACED_MONTH
    tables.write_bronze(i.bronze_trips, layout.trips_bronze)
    tables.write_bronze(pivot_observations(i.observations), layout.weather_bronze, date_col="weather_date")
    build_marts(i.spark, layout, check=False)
    of_month = (F.year("started_at") == year) & (F.month("started_at") == month)
    tables.write_bronze(i.bronze_trips.where(of_month & (F.col("member_casual") == "member")), layout.trips_bronze, year, month)
    build_marts(i.spark, layout, check=False, months=[REPLACED_MONTH])
    counts = [
        df.groupBy(F.lit(number).cast("bigint").alias("version"), F.lit(name).alias("mart"), TRIP_MONTH).agg(F.count(F.lit(1)).alias("n_rows"))
        for number in published(i.spark, layout)
        for name, df in load_marts(i.spark, layout, number).items()
    ]
    return reduce(DataFrame.unionByName, counts)


def _mart_roundtrip(i: Inputs) -> DataFrame:
    """Store the station-daily mart in month folders and read it back in order."""
    path = scratch_path(i.spark, "fct_station_daily")
    stored = with_trip_month(i.station_daily)
    tables.write_mart(stored, path, marts.mart_sort_keys("fct_station_daily"), [TRIP_MONTH])
    df = tables.read_mart(i.spark, path, i.station_daily.columns)
    return df.orderBy(*marts.mart_sort_keys("fct_station_daily"))


def _csv_export_roundtrip(i: Inputs) -> DataFrame:
    path = scratch_path(i.spark, "export")
    days = i.days
    tables.export_csv(days, path)
    return tables.read_csv_export(i.spark, path, days.schema)


def _holiday_days(i: Inputs) -> DataFrame:
    """Trips on holidays: the seed is published as CSV, scanned back with its
    declared schema, joined into the enriched days, and holidays are selected."""
    seed = read_holidays(i.spark, write_seed_csv(i.spark, scratch_path(i.spark, "seed")))
    enriched = marts.daily_enriched(i.daily, i.weather, seed)
    days = reports.filter_days(enriched, reports.DayFilters(holiday=reports.HOLIDAYS_ONLY))
    return days.select(
        F.col("trip_date").alias("holiday_date"),
        "holiday_name",
        "is_holiday",
        "total_trips",
        "member_trips",
        "casual_trips",
    )


def _month_windows(i: Inputs) -> DataFrame:
    """For each month of ``orders``: the monthly run on day 5 loads the previous
    month; its window, zero-padded month and YYYYMM tag."""
    months = fixtures.fixture_requested_months(i.spark, i.sf_dir)
    as_of = F.make_date("year", "month", F.lit(5))
    load = previous_month(as_of)
    first, last = month_window(F.year(load), F.month(load))
    return months.select(
        "year",
        "month",
        as_of.alias("as_of"),
        F.year(load).alias("load_year"),
        F.month(load).alias("load_month"),
        first.alias("month_start"),
        last.alias("month_end"),
        zero_pad_month(F.month(load)).alias("month_text"),
        yyyymm(load).alias("period"),
    )


def _weather_window(i: Inputs) -> DataFrame:
    """Weather of one landed month: observations inside the month window only."""
    first, last = month_window(F.lit(WEATHER_WINDOW[0]), F.lit(WEATHER_WINDOW[1]))
    obs = i.observations.where(F.col("obs_date").between(first, last))
    return stage_weather(pivot_observations(obs))


def _empty_selection(i: Inputs) -> DataFrame:
    """Flow reports for an empty bucket list and an empty season list have no rows but
    the 11 flow columns: they add nothing to the report of all days."""
    no_buckets = reports.top_flows_hourly(i.flows_hourly, i.days, reports.HourFilters(hour_buckets=()))
    no_days = reports.filter_days(i.enriched, reports.DayFilters(seasons=()))
    nothing = no_buckets.unionByName(reports.top_flows_daily(i.flows_daily, no_days))
    return nothing.unionByName(reports.top_flows_daily(i.flows_daily, i.days))


def _hourly_selection(i: Inputs) -> DataFrame:
    return reports.selected_station_hours(i.station_hourly, i.days, reports.HourFilters())


BUILDERS: dict[str, Callable[[Inputs], DataFrame]] = {
    "stage_trips": lambda i: i.staged,
    "trip_facts": lambda i: i.facts,
    "trip_daily": lambda i: i.daily,
    "station_daily": lambda i: i.station_daily,
    "station_hourly": lambda i: i.station_hourly,
    "flows_daily": lambda i: i.flows_daily,
    "flows_hourly": lambda i: i.flows_hourly,
    "weather_pivot": lambda i: pivot_observations(i.observations),
    "stage_weather": lambda i: i.weather,
    "daily_enriched": lambda i: i.enriched,
    "holiday_days": _holiday_days,
    "kpis": lambda i: rounded(reports.kpis(i.days), ["avg_daily_trips", "avg_trip_duration_minutes"]),
    "date_bounds": lambda i: reports.date_bounds(i.enriched),
    "season_options": lambda i: reports.season_options(i.enriched),
    "year_options": lambda i: reports.year_options(i.enriched),
    "filtered_days": lambda i: reports.filter_days(i.enriched, SAMPLE_DAYS),
    "filtered_weekends": lambda i: reports.filter_days(i.enriched, WEEKEND_DAYS),
    "rush_hour_trips": (
        lambda i: reports.hourly_trips(reports.selected_station_hours(i.station_hourly, i.days, RUSH_HOURS))
    ),
    "weekday_profile": lambda i: rounded(reports.weekday_profile(i.days), ["avg_total_trips"]),
    "weather_scatter": lambda i: reports.weather_scatter(i.days),
    "daily_series": lambda i: reports.daily_series(i.days),
    "listed_days_flows": (
        lambda i: reports.top_flows_daily(i.flows_daily, reports.filter_days(i.enriched, LISTED_DAYS))
    ),
    "top_flows_daily": lambda i: reports.top_flows_daily(i.flows_daily, i.days),
    "flow_map_daily": (
        lambda i: reports.flow_table(
            reports.with_flow_weight(reports.top_flows_daily(i.flows_daily, i.days))
        )
    ),
    "top_flows_hourly": (
        lambda i: rounded(
            reports.top_flows_hourly(i.flows_hourly, i.days, SAMPLE_HOURS),
            ["start_lat", "start_lng", "end_lat", "end_lng"],
        )
    ),
    "empty_selection": _empty_selection,
    "station_activity_daily": (
        lambda i: reports.map_stations(reports.station_activity_daily(i.station_daily, i.days))
    ),
    "station_table_daily": (
        lambda i: reports.station_table(reports.station_activity_daily(i.station_daily, i.days))
    ),
    "station_activity_hourly": (
        lambda i: reports.map_stations(
            reports.station_activity_hourly(i.station_hourly, i.days, SAMPLE_HOURS)
        )
    ),
    "hourly_trips": lambda i: reports.hourly_trips(_hourly_selection(i)),
    "hourly_rider_mix": lambda i: reports.hourly_rider_mix(_hourly_selection(i)),
    "bucket_trips": lambda i: reports.bucket_trips(_hourly_selection(i)),
    "hourly_leaders": lambda i: reports.hourly_leaders(_hourly_selection(i)),
    "top_days": lambda i: reports.top_days(i.days),
    "month_windows": _month_windows,
    "pending_months": (
        lambda i: pending_months(
            fixtures.fixture_requested_months(i.spark, i.sf_dir), fixtures.fixture_ledger(i.spark, i.sf_dir)
        )
    ),
    "quality_report": lambda i: quality.check_results(i.with_repeated_rides().checked_tables()),
    "quality_duplicates": lambda i: quality.duplicate_values(i.with_repeated_rides().checked_tables()),
    "quality_unexpected": lambda i: quality.unexpected_values(i.with_repeated_rides().checked_tables()),
    "quality_after_refresh": _quality_after_refresh,
    "marts_by_version": _marts_by_version,
    "weather_window": _weather_window,
    "csv_union_roundtrip": _csv_union_roundtrip,
    "json_observations": _json_observations,
    "bronze_roundtrip": _bronze_roundtrip,
    "ledger_roundtrip": _ledger_roundtrip,
    "ledger_lookup": _ledger_lookup,
    "ledger_compacted": _ledger_compacted,
    "monthly_load_marts": _monthly_load_marts,
    "mart_roundtrip": _mart_roundtrip,
    "csv_export_roundtrip": _csv_export_roundtrip,
}
QUERIES: dict[str, Query] = {name: _q(build) for name, build in BUILDERS.items()}
