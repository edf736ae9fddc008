"""Monthly run (trips -> weather -> marts) and a ledger-driven backfill of a month range."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from velomart.plans import versions
from velomart.plans.build import build_marts, trip_months_in_partition
from velomart.plans.ingest import (
    LOADED,
    SKIPPED_CLAIMED,
    SKIPPED_EXISTS,
    TRIPS_PIPELINE,
    WEATHER_PIPELINE,
    Layout,
    ingest_trips_month,
    ingest_weather_month,
)
from velomart.plans.ledger import STALE, SUCCESS, LoadLedger, pending_months
from velomart.sources.replace import Folder
from velomart.sources.tables import month_partition, path_exists

# Events of the marts: a trip month is stale from before a load that touches it until a
# build of it has passed its checks.
MARTS_PIPELINE = "marts"
# Which trip months a landed month holds: one event for each of them, and stale from
# before a load until its rows have been looked at.
_SPAN = "span {:04d}-{:02d}"

Month = tuple[int, int]


def previous_month_of(as_of: dt.date | None = None) -> tuple[int, int]:
    """(year, month) before ``as_of`` (default: today in UTC) -- the month a
    scheduled run early in a month loads."""
    day = as_of or dt.datetime.now(dt.timezone.utc).date()
    first = day.replace(day=1)
    prev = first - dt.timedelta(days=1)
    return prev.year, prev.month


def monthly_load(
    spark: SparkSession,
    layout: Layout,
    year: int | None = None,
    month: int | None = None,
    force: bool = False,
    station: str | None = None,
    check: bool = True,
    full_rebuild: bool = False,
) -> dict[str, object]:
    """Trips -> weather -> marts for one month (default: the previous month).

    Each step raises on failure, so a later step never runs on a failed one.
    Marts are refreshed for the trip months the load touches -- the landed
    month plus every month of ``started_at`` found in its bronze partition
    before and after the load -- unless ``full_rebuild`` asks for all months.
    """
    if year is None or month is None:
        year, month = previous_month_of()
    ledger = LoadLedger(spark, layout.ledger)
    trips, weather, touched = _load(spark, layout, ledger, year, month, force, station)
    others = touched if SKIPPED_CLAIMED in (trips, weather) else set()
    marts, months = _build_stale(spark, layout, ledger, check, touched, full_rebuild, others)
    ledger.compact()
    return {"year": year, "month": month, "trips": trips, "weather": weather, "months": months, "marts": marts}


def _load(
    spark: SparkSession, layout: Layout, ledger: LoadLedger, year: int, month: int, force: bool, station: str | None
) -> tuple[str, str, set[Month]]:
    """Loads a landed month; returns both outcomes and the trip months it touches."""
    partition = month_partition(layout.trips_bronze, year, month)
    before: set[Month] = set()
    if path_exists(spark, partition):
        before = set(trip_months_in_partition(spark, layout, year, month))
    if force or not before:
        # What the load may change is marked first: a load or build that fails later
        # leaves the mark, and the next run builds these months.
        ledger.record_all(MARTS_PIPELINE, before | {(year, month)}, layout.marts, STALE)
        ledger.record_all(_SPAN.format(year, month), [(year, month)], partition, STALE)
    trips = ingest_trips_month(spark, layout, ledger, year, month, force)
    after = before
    if trips == LOADED:
        after = set(trip_months_in_partition(spark, layout, year, month))
    if trips == LOADED or (trips == SKIPPED_EXISTS and (year, month) not in _spans(ledger)):
        # Also for a folder whose load was lost before its record.
        if not ledger.already_loaded(TRIPS_PIPELINE, year, month):
            ledger.record(TRIPS_PIPELINE, year, month, partition)
        ledger.record_all(MARTS_PIPELINE, before | after | {(year, month)}, layout.marts, STALE)
        ledger.record_all(_SPAN.format(year, month), after | {(year, month)}, partition, SUCCESS)
    weather = ingest_weather_month(spark, layout, ledger, year, month, force, station)
    if weather == LOADED:
        ledger.record_all(MARTS_PIPELINE, [(year, month)], layout.marts, STALE)
    return trips, weather, {(year, month)} | before | after


def _stale_months(spark: SparkSession, layout: Layout, ledger: LoadLedger) -> set[Month]:
    """Trip months whose marts are behind: marked stale since the last checked build, or
    loaded and never built.  One row for each calendar month, so collecting is bounded."""
    latest = ledger.latest(MARTS_PIPELINE)
    stale = {(r.year, r.month) for r in latest.where(F.col("status") != SUCCESS).collect()}
    loaded = ledger.successes(TRIPS_PIPELINE).select("year", "month").distinct()
    stale |= {(r.year, r.month) for r in loaded.join(latest, ["year", "month"], "left_anti").collect()}
    for year, month in sorted(stale):
        if path_exists(spark, month_partition(layout.trips_bronze, year, month)):
            stale |= set(trip_months_in_partition(spark, layout, year, month))
    return stale


def _spans(ledger: LoadLedger) -> dict[Month, set[Month]]:
    """Trip months of each landed month, without those that a load has marked and not
    recorded since.  Bounded by the calendar."""
    rows = ledger.read().where(F.col("pipeline_name").startswith("span "))
    latest = rows.groupBy("pipeline_name").agg(F.max(F.struct("loaded_at", "status"))["status"].alias("now"))
    held = rows.where(F.col("status") == SUCCESS).join(latest.where(F.col("now") == SUCCESS), "pipeline_name")
    spans: dict[Month, set[Month]] = {}
    for r in held.select("pipeline_name", "year", "month").distinct().collect():
        y, _, m = r.pipeline_name.removeprefix("span ").partition("-")
        spans.setdefault((int(y), int(m)), set()).add((r.year, r.month))
    return spans


def _bronze_months(spark: SparkSession, layout: Layout) -> set[Month]:
    """Landed months that have a folder in trip bronze, whatever the ledger says."""
    root = Folder(spark, layout.trips_bronze)
    return {
        (int(y.removeprefix("year=")), int(m.removeprefix("month=")))
        for y in root.children()
        if y.startswith("year=")
        for m in Folder(spark, f"{root.path}/{y}").children()
        if m.startswith("month=")
    }


def _landed_with(spark: SparkSession, layout: Layout, ledger: LoadLedger, months: set[Month]) -> list[Month] | None:
    """Landed months that hold trips of ``months``, by the spans recorded at their loads;
    None if a landed month or a folder of bronze has no recorded span."""
    landed = {(r.year, r.month) for r in ledger.successes(TRIPS_PIPELINE).select("year", "month").distinct().collect()}
    spans = _spans(ledger)
    if (landed | _bronze_months(spark, layout)) - set(spans):
        return None
    return sorted(month for month, held in spans.items() if held & months)


def _build_stale(
    spark: SparkSession, layout: Layout, ledger: LoadLedger, check: bool, touched: set[Month], full_rebuild: bool = False,
    others: set[Month] = frozenset(),
) -> tuple[dict[str, str], list[Month] | None]:
    """Builds the months that a run touched and those that earlier runs left stale; they
    count as built once every check has passed.  Months of ``others`` are being loaded by
    another run, which builds them."""
    months = (touched | _stale_months(spark, layout, ledger)) - others
    if not months:
        return {}, []
    # The months count as built from here on: what a load marks while they are built stays stale.
    began = ledger.now()
    if full_rebuild or versions.current(spark, layout) is None:
        marts = build_marts(spark, layout, check)
    else:
        marts = build_marts(spark, layout, check, months=sorted(months), partitions=_landed_with(spark, layout, ledger, months))
    ledger.record_all(MARTS_PIPELINE, months, layout.marts, SUCCESS, began)
    return marts, None if full_rebuild else sorted(months)


def requested_months(spark: SparkSession, pipelines: list[str], first: tuple[int, int], last: tuple[int, int]):
    """(pipeline_name, year, month) for every pipeline and every month from
    ``first`` to ``last`` inclusive (two generated columns, no join)."""
    start = F.make_date(F.lit(first[0]), F.lit(first[1]), F.lit(1))
    end = F.make_date(F.lit(last[0]), F.lit(last[1]), F.lit(1))
    return (
        spark.range(1)
        .select(F.explode(F.array(*[F.lit(p) for p in pipelines])).alias("pipeline_name"))
        .select("pipeline_name", F.explode(F.sequence(start, end, F.expr("INTERVAL 1 MONTH"))).alias("m"))
        .select("pipeline_name", F.year("m").alias("year"), F.month("m").alias("month"))
    )


def backfill(
    spark: SparkSession,
    layout: Layout,
    first: tuple[int, int],
    last: tuple[int, int],
    station: str | None = None,
    check: bool = True,
) -> dict[str, object]:
    """Load every month of a range that the ledger does not record as loaded.

    The pending months come from the set form of the ledger test (requested
    months anti-joined with successful loads), one row per month, so the list
    the driver walks is bounded by the calendar.  Marts are then refreshed once
    for all touched trip months, and for those that an earlier run loaded but did
    not build (it failed on a later month, or on a check).
    """
    ledger = LoadLedger(spark, layout.ledger)
    requested = requested_months(spark, [TRIPS_PIPELINE, WEATHER_PIPELINE], first, last)
    pending = pending_months(requested, ledger.read()).collect()
    todo = sorted({(r.year, r.month) for r in pending})
    touched: set[Month] = set()
    others: set[Month] = set()
    results = {}
    for year, month in todo:
        trips, weather, months = _load(spark, layout, ledger, year, month, False, station)
        results[(year, month)] = (trips, weather)
        if SKIPPED_CLAIMED in (trips, weather):
            others |= months
        else:
            touched |= months
    marts, built = _build_stale(spark, layout, ledger, check, touched, others=others)
    ledger.compact()
    return {"loaded": results, "months": built, "marts": marts}
