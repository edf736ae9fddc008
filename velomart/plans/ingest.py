"""Idempotent monthly ingest of landed trip CSVs and weather pages into bronze.

A month is skipped when its bronze partition already exists or the ledger has a
successful load for it; ``force`` overrides both.  The write replaces only that
month's partition (dynamic partition overwrite), so a forced rerun never
duplicates rows; each completed load appends one ledger row.  A run claims the month
before it looks (``plans/claims.py``): of several runs at once one loads, the others skip.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from velomart.functions.time import month_window_values
from velomart.operators.weather import pivot_observations
from velomart.plans.claims import claimed
from velomart.plans.ledger import LoadLedger
from velomart.sources.landing import read_observation_pages, read_trip_csvs
from velomart.sources.tables import month_partition, path_exists, write_bronze

KEY_BUCKETS = 16
TRIPS_PIPELINE = "trips"
WEATHER_PIPELINE = "weather"

LOADED, SKIPPED_EXISTS, SKIPPED_RECORDED = "loaded", "skipped: partition exists", "skipped: already recorded"
SKIPPED_CLAIMED = "skipped: another run loads it"


@dataclass(frozen=True)
class Layout:
    """Folders of one deployment (all on shared storage).

    Landed inputs are expected under ``<landing>/<YYYYMM>/``.  Trip and weather
    bronze live under separate roots so partition discovery sees one layout each.
    """

    trips_landing: str
    weather_landing: str
    trips_bronze: str
    weather_bronze: str
    marts: str
    ledger: str
    seed: str | None = None
    checks: str | None = None  # stored check results; by default beside the marts
    key_buckets: int | None = None  # of stored ride ids (a bucket of a month is one folder)

    @property
    def buckets(self) -> int:
        return self.key_buckets or KEY_BUCKETS

    @property
    def check_root(self) -> str:
        return (self.checks or f"{self.marts.rstrip('/')}_checks").rstrip("/")

    @property
    def claim_root(self) -> str:
        return f"{self.ledger.rstrip('/')}_claims"

    def landed(self, root: str, year: int, month: int) -> str:
        return f"{root.rstrip('/')}/{year:04d}{month:02d}"


def _skip_reason(spark: SparkSession, ledger: LoadLedger, pipeline: str, partition: str, year: int, month: int):
    if path_exists(spark, partition):
        return SKIPPED_EXISTS
    if ledger.already_loaded(pipeline, year, month):
        return SKIPPED_RECORDED
    return None


def claim_name(pipeline: str, year: int, month: int) -> str:
    return f"{pipeline}-{year:04d}-{month:02d}"


def ingest_trips_month(
    spark: SparkSession, layout: Layout, ledger: LoadLedger, year: int, month: int, force: bool = False
) -> str:
    """Land one month of trip CSVs as the bronze partition ``year=YYYY/month=MM``."""
    partition = month_partition(layout.trips_bronze, year, month)
    with claimed(spark, layout.claim_root, claim_name(TRIPS_PIPELINE, year, month)) as claim:
        if claim is None:
            return SKIPPED_CLAIMED
        if not force:
            reason = _skip_reason(spark, ledger, TRIPS_PIPELINE, partition, year, month)
            if reason:
                return reason
        trips = read_trip_csvs(spark, layout.landed(layout.trips_landing, year, month))
        write_bronze(trips, layout.trips_bronze, year, month, ready=claim.assert_held)
        ledger.record(TRIPS_PIPELINE, year, month, partition)
    return LOADED


def ingest_weather_month(
    spark: SparkSession,
    layout: Layout,
    ledger: LoadLedger,
    year: int,
    month: int,
    force: bool = False,
    station: str | None = None,
) -> str:
    """Pivot one month of landed observation pages into daily weather rows.

    Only observations inside the month window are kept; a month with none
    raises ``ValueError`` (an empty download is an error, not an empty month).
    """
    partition = month_partition(layout.weather_bronze, year, month)
    with claimed(spark, layout.claim_root, claim_name(WEATHER_PIPELINE, year, month)) as claim:
        if claim is None:
            return SKIPPED_CLAIMED
        if not force:
            reason = _skip_reason(spark, ledger, WEATHER_PIPELINE, partition, year, month)
            if reason:
                return reason
        first, last = month_window_values(year, month)
        obs = read_observation_pages(spark, layout.landed(layout.weather_landing, year, month), station).where(
            F.col("obs_date").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
        )
        if obs.isEmpty():
            raise ValueError(f"no weather observations for {year:04d}-{month:02d}; check station, dates or landing")
        write_bronze(pivot_observations(obs), layout.weather_bronze, year, month, ready=claim.assert_held)
        ledger.record(WEATHER_PIPELINE, year, month, partition)
    return LOADED
