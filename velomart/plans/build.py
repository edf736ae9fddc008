"""Mart build job: stage -> check -> marts in dependency order -> check.

Marts are parquet tables under ``layout.marts``, each stored in month folders
(``trip_month=YYYY-MM-01``) of the builds that wrote them (``plans/versions.py``).  Two
modes:

* full rebuild (``months=None``): every mart is recomputed from all of bronze
  and replaced as a whole;
* month refresh (``months=[(year, month), ...]``): only those trip months are
  recomputed -- bronze is read through a ``started_at`` range that parquet
  pushes down, and, where ``partitions`` says which landed months hold them, only
  from those folders -- and only their folders are replaced, or removed where no row
  is left.  Every mart row belongs to the month of its trip date, so a refresh gives
  the same rows as a full rebuild for those months.

Every mart is written to folders of this build and checked.  Downstream marts read their
inputs back from the written tables, which cuts the lineage at every stage.  A failing
check stops its lane before anything downstream is written.  Once all marts are there, one
step makes them the current version; until then, and where a build fails, readers see the
marts of before.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor, wait
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from velomart.operators import marts
from velomart.operators.joins import TRIP_MONTH, with_trip_month
from velomart.operators.quality import assert_checks_pass, checks_for, collect_check_results
from velomart.operators.staging import stage_trips, stage_weather
from velomart.plans import versions
from velomart.plans.check_states import refresh_report, stored_tables
from velomart.plans.ingest import Layout
from velomart.schemas import HOLIDAY_SCHEMA, STAGED_TRIP_COLUMNS, TRIP_BRONZE_SCHEMA, WEATHER_SCHEMA
from velomart.sources.replace import Folder
from velomart.sources.seed import read_holidays
from velomart.sources.tables import read_bronze_trips, read_bronze_weather, read_mart, write_mart

MART_ORDER = [
    "fct_trips",
    "fct_trip_daily",
    "fct_trip_daily_enriched",
    "fct_station_daily",
    "fct_station_hourly",
    "fct_station_flows_daily",
    "fct_station_flows_hourly",
]

Months = Sequence[tuple[int, int]]


def mart_path(layout: Layout, name: str) -> str:
    return f"{layout.marts.rstrip('/')}/{name}"


def _month_bounds(months: Months) -> list[tuple[dt.date, dt.date]]:
    bounds = []
    for year, month in sorted(set(months)):
        first = dt.date(year, month, 1)
        bounds.append((first, dt.date(year + month // 12, month % 12 + 1, 1)))
    return bounds


def in_months(col: str, months: Months, as_timestamp: bool) -> Column:
    """``col`` falls in one of the months: an OR of half-open literal ranges,
    which parquet evaluates against row-group min/max statistics."""

    def lit(d: dt.date) -> Column:
        return F.lit(f"{d.isoformat()} 00:00:00").cast("timestamp_ntz") if as_timestamp else F.lit(d)

    ranges = [(F.col(col) >= lit(a)) & (F.col(col) < lit(b)) for a, b in _month_bounds(months)]
    return reduce(lambda x, y: x | y, ranges)


def _landed_in(partitions: Months) -> Column:
    """Bronze folders of these landed months (partition columns, so others are not listed)."""
    pairs = [(F.col("year").cast("int") == y) & (F.col("month").cast("int") == m) for y, m in sorted(set(partitions))]
    return reduce(lambda x, y: x | y, pairs, F.lit(False))


def _gate(tables: dict[str, DataFrame]) -> None:
    checks = checks_for(tables)
    if checks:
        assert_checks_pass(collect_check_results(tables, checks))


def _materialise(spark: SparkSession, layout: Layout, build: str, name: str, df: DataFrame, check: bool) -> DataFrame:
    """Write the folders of one mart for this build and return what was written.

    The rows are checked before they stand under the mart's name.  Unique ride ids need no
    second check on the facts, which are a subset of the staged trips.
    """
    path = versions.build_path(mart_path(layout, name), build)
    stored_df = with_trip_month(df)
    write_mart(
        stored_df,
        path,
        marts.mart_sort_keys(name),
        [TRIP_MONTH],
        check=(lambda rows: _gate({name: rows})) if check else None,
        # Trip facts come from bronze months as they are stored; the others are aggregates.
        rebalance=name != "fct_trips",
    )
    return read_mart(spark, path, schema=stored_df.schema)


def build_marts(
    spark: SparkSession,
    layout: Layout,
    check: bool = True,
    concurrent_jobs: int = 5,
    months: Months | None = None,
    partitions: Months | None = None,
    keep: int = versions.KEPT_VERSIONS,
) -> dict[str, str]:
    """Rebuild every mart (or refresh ``months``) and make the result the current version;
    returns mart name -> root folder (read them with :func:`load_marts`).

    The trip chain (facts -> daily -> enriched) and the four station / flow marts
    do not depend on each other, so they are submitted as concurrent Spark jobs
    from driver threads (Spark's scheduler interleaves their stages on the
    executors).  Any failure -- a task error or a failed check -- is raised
    after the running lanes finish; nothing downstream of a failed lane runs.
    ``partitions`` are the landed months that hold trips of ``months`` (default: any);
    ``keep`` is the number of versions that stay readable.
    """
    if months is not None and not months:
        return {name: mart_path(layout, name) for name in MART_ORDER}
    base, build = versions.current(spark, layout), versions.new_build()
    all_staged = stage_trips(read_bronze_trips(spark, layout.trips_bronze))
    all_weather = stage_weather(read_bronze_weather(spark, layout.weather_bronze))
    holidays = read_holidays(spark, layout.seed)
    staged, weather = all_staged, all_weather
    if months is None:
        if check:
            _gate({"stg_trips": staged, "stg_weather_daily": weather, "holiday_calendar": holidays})
    else:
        trip_slice = in_months("started_at", months, as_timestamp=True)
        day_slice = in_months("weather_date", months, as_timestamp=False)
        bronze = read_bronze_trips(spark, layout.trips_bronze)
        if partitions is not None:
            bronze = bronze.where(_landed_in(partitions))
        staged = stage_trips(bronze).where(trip_slice)
        weather = all_weather.where(day_slice)
        if check:
            # A refresh checks what a full build would, from stored results of the
            # folders that did not change.
            report = refresh_report(spark, layout, stored_tables(spark, layout))
            assert_checks_pass(report.collect())

    def mat(name: str, df: DataFrame) -> DataFrame:
        return _materialise(spark, layout, build, name, df, check)

    def trip_chain() -> None:
        facts = mat("fct_trips", marts.trip_facts(staged))
        daily = mat("fct_trip_daily", marts.trip_daily(facts))
        mat("fct_trip_daily_enriched", marts.daily_enriched(daily, weather, holidays))

    lanes = [
        trip_chain,
        lambda: mat("fct_station_daily", marts.station_daily(staged)),
        lambda: mat("fct_station_hourly", marts.station_hourly(staged)),
        lambda: mat("fct_station_flows_daily", marts.flows_daily(staged)),
        lambda: mat("fct_station_flows_hourly", marts.flows_hourly(staged)),
    ]
    folders = None if months is None else [f"{TRIP_MONTH}={first.isoformat()}" for first, _ in _month_bounds(months)]
    try:
        _run_lanes(spark, lanes, concurrent_jobs)
        written = {}
        for name in MART_ORDER:
            held = Folder(spark, versions.build_path(mart_path(layout, name), build)).children()
            written[name] = [f for f in held if f.startswith(f"{TRIP_MONTH}=")]
        versions.publish(spark, layout, base, build, written, folders)
    except BaseException:
        versions.discard(spark, layout, MART_ORDER, build)
        raise
    versions.clean(spark, layout, MART_ORDER, keep)
    return {name: mart_path(layout, name) for name in MART_ORDER}


def _run_lanes(spark: SparkSession, lanes: list, concurrent_jobs: int) -> None:
    if concurrent_jobs <= 1:
        for lane in lanes:
            lane()
        return

    def in_pool(index: int, lane) -> None:
        # One scheduler pool per lane: with FAIR scheduling a large lane
        # does not hold every executor while the small marts wait.
        try:
            context = spark.sparkContext
        except Exception:  # Spark Connect: the server schedules
            context = None
        if context is not None:
            context.setLocalProperty("spark.scheduler.pool", f"mart-lane-{index}")
        try:
            lane()
        finally:
            if context is not None:
                context.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(max_workers=concurrent_jobs, thread_name_prefix="mart") as pool:
        futures = [pool.submit(in_pool, k, lane) for k, lane in enumerate(lanes)]
        wait(futures)
    for f in futures:
        f.result()


def trip_months_in_partition(spark: SparkSession, layout: Layout, year: int, month: int) -> list[tuple[int, int]]:
    """Trip months (of ``started_at``) present in one landed bronze partition.

    A monthly refresh recomputes these months (before and after a reload), so
    a trip landed in a neighbouring month's file is never missed.  The result
    has one row per distinct month, so collecting it is bounded.
    """
    trips = read_bronze_trips(spark, layout.trips_bronze).where((F.col("year") == year) & (F.col("month") == month))
    rows = (
        trips.where(F.col("started_at").isNotNull())
        .select(F.year("started_at").alias("y"), F.month("started_at").alias("m"))
        .distinct()
        .collect()
    )
    return sorted((r.y, r.m) for r in rows)


def mart_schemas(spark: SparkSession) -> dict[str, StructType]:
    """Stored schema of every mart (with ``trip_month``), from the builders
    applied to empty inputs -- analysis only, no data is read."""
    staged = spark.createDataFrame([], TRIP_BRONZE_SCHEMA).select(*STAGED_TRIP_COLUMNS)
    weather = spark.createDataFrame([], WEATHER_SCHEMA)
    facts = marts.trip_facts(staged)
    daily = marts.trip_daily(facts)
    frames = {
        "fct_trips": facts,
        "fct_trip_daily": daily,
        "fct_trip_daily_enriched": marts.daily_enriched(daily, weather, spark.createDataFrame([], HOLIDAY_SCHEMA)),
        "fct_station_daily": marts.station_daily(staged),
        "fct_station_hourly": marts.station_hourly(staged),
        "fct_station_flows_daily": marts.flows_daily(staged),
        "fct_station_flows_hourly": marts.flows_hourly(staged),
    }
    return {name: with_trip_month(df).schema for name, df in frames.items()}


def stored_report(spark: SparkSession, layout: Layout) -> DataFrame:
    """The report of all declared checks over staging, marts and seed, from stored
    results: after a refresh only the folders that changed are read."""
    return refresh_report(spark, layout, stored_tables(spark, layout, load_marts(spark, layout), versions.current(spark, layout)))


def load_marts(spark: SparkSession, layout: Layout, version: int | None = None) -> dict[str, DataFrame]:
    """The stored marts as DataFrames (for the report layer), read with their declared
    schemas: all of the current version, or of another that is kept."""
    held = versions.current(spark, layout) if version is None else versions.read_version(spark, layout, version)
    if held is None:
        raise FileNotFoundError(f"no version of the marts in {layout.marts}")
    schemas = mart_schemas(spark)
    return {name: _read_version(spark, mart_path(layout, name), held, name, schemas[name]) for name in MART_ORDER}


def _read_version(spark: SparkSession, root: str, version: versions.MartVersion, name: str, schema: StructType) -> DataFrame:
    paths = version.paths(root, name)
    if not paths:
        return spark.createDataFrame([], schema)
    # The builds' names are a folder column of the scan, which no reader needs.
    reader = spark.read.schema(StructType([*schema.fields, StructField("build", StringType())]))
    return reader.option("basePath", root).parquet(*paths).select(*schema.names)
