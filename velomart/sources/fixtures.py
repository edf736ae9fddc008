"""Trip-, weather- and ledger-shaped inputs derived from the shared test tables.

The reference reads landed trip CSVs and weather pages that we do not have; the
recipe of ``FIXTURES.md`` turns every row of ``events`` into one trip and one
observation, and the months of ``orders`` into load-ledger rows.  Every row is
kept: the derived tables grow with the source tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velomart.schemas import TRIP_CSV_TYPES

# Fixed values of the fixture recipe.
DAYS_PER_USER_STEP = 30
SECOND_YEAR_EVERY = 5
DAYS_PER_YEAR = 366
REPEATED_RIDE_EVERY = 499
DURATION_PRIME = 7919
DURATION_SPAN_SECONDS = 7200
DURATION_SHIFT_SECONDS = 300
MEMBER_EVENT_TYPES = ["purchase", "signup"]
UNKNOWN_EVENT_TYPES = ["error"]
OBSERVATION_KINDS = ["TMAX", "TMIN", "PRCP", "SNOW", "AWND"]  # index = event_id % 7
OTHER_OBSERVATION_KIND = "TAVG"
MISSING_WEATHER_DAY_OF_MONTH = 13
TRIPS_PIPELINE = "trips"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _shifted_start(uid):
    """The event's time, spread over twelve months; every fifth user rides a year later."""
    year = F.when(uid % SECOND_YEAR_EVERY == 0, DAYS_PER_YEAR).otherwise(0)
    return F.col("ts") + F.make_dt_interval(days=(F.lit(DAYS_PER_USER_STEP) * (uid % 12) + year).cast("int"))


def fixture_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze-shaped trips (CSV column names and types), one per ``events`` row."""
    eid, uid = F.col("event_id"), F.col("user_id")
    started = _shifted_start(uid)
    seconds = ((eid * DURATION_PRIME) % DURATION_SPAN_SECONDS - DURATION_SHIFT_SECONDS).cast("int")

    def nulled(mod: int, value):
        return F.when(eid % mod == 0, F.lit(None)).otherwise(value)

    start_station = (eid % 17).cast("string")
    end_station = (uid % 11).cast("string")

    columns = {
        "ride_id": eid.cast("string"),
        "rideable_type": F.when(eid % 3 == 0, "electric_bike").otherwise("classic_bike"),
        "started_at": started,
        "ended_at": started + F.make_dt_interval(secs=seconds),
        "start_station_name": nulled(43, F.concat(F.lit("Station "), start_station)),
        "start_station_id": nulled(41, F.concat(F.lit("S"), start_station)),
        "end_station_name": nulled(53, F.concat(F.lit("Station "), end_station)),
        "end_station_id": nulled(47, F.concat(F.lit("S"), end_station)),
        "start_lat": nulled(59, F.lit(40.5) + (eid % 64) / F.lit(64.0)),
        "start_lng": F.lit(-74.25) + (eid % 32) / F.lit(64.0),
        "end_lat": F.lit(40.5) + (uid % 64) / F.lit(64.0),
        "end_lng": nulled(61, F.lit(-74.25) + (uid % 32) / F.lit(64.0)),
        "member_casual": F.when(F.col("event_type").isin(*MEMBER_EVENT_TYPES), "member")
        .when(F.col("event_type").isin(*UNKNOWN_EVENT_TYPES), "unknown")
        .otherwise("casual"),
    }
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    return events.select(
        *[columns[name].cast(dtype).alias(name) for name, dtype in TRIP_CSV_TYPES.items()]
    )


def with_repeats(trips: DataFrame) -> DataFrame:
    """The trips, and some of them a second time: what the unique checks are to find."""
    return trips.unionByName(trips.where(F.col("ride_id").try_cast("long") % REPEATED_RIDE_EVERY == 0))


def fixture_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long-form daily observations (obs_date, datatype, value, seq).

    What is observed on day 13 of a month is of another kind, so the weather join
    misses that day.
    """
    eid = F.col("event_id")
    obs_date = _shifted_start(F.col("user_id")).cast("date")
    kind = F.when(F.dayofmonth(obs_date) == MISSING_WEATHER_DAY_OF_MONTH, OTHER_OBSERVATION_KIND)
    kind = kind.when(eid % 7 == 0, OBSERVATION_KINDS[0])
    for idx, name in enumerate(OBSERVATION_KINDS[1:], start=1):
        kind = kind.when(eid % 7 == idx, name)
    kind = kind.otherwise(OTHER_OBSERVATION_KIND)
    return table(spark, sf_dir, "events").select(
        obs_date.alias("obs_date"), kind.alias("datatype"), F.col("value"), eid.alias("seq")
    )


def fixture_requested_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pipeline_name, year, month) for every distinct month of ``orders``."""
    d = F.col("o_orderdate")
    return (
        table(spark, sf_dir, "orders")
        .select(
            F.lit(TRIPS_PIPELINE).alias("pipeline_name"),
            F.year(d).alias("year"),
            F.month(d).alias("month"),
        )
        .distinct()
    )


def fixture_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger rows: even months loaded successfully, month 3 failed."""
    months = fixture_requested_months(spark, sf_dir)
    mm = F.lpad(F.col("month").cast("string"), 2, "0")
    loaded = F.make_timestamp_ntz(
        F.year(F.add_months(F.make_date("year", "month", F.lit(1)), 1)),
        F.month(F.add_months(F.make_date("year", "month", F.lit(1)), 1)),
        F.lit(5),
        F.lit(6),
        F.lit(0),
        F.lit(0),
    )
    return months.where((F.col("month") % 2 == 0) | (F.col("month") == 3)).select(
        "pipeline_name",
        F.col("year").cast("int").alias("year"),
        F.col("month").cast("int").alias("month"),
        F.concat(F.lit("bronze/trips/year="), F.col("year").cast("string"), F.lit("/month="), mm).alias(
            "output_path"
        ),
        F.when(F.col("month") % 2 == 0, "success").otherwise("failed").alias("status"),
        loaded.alias("loaded_at"),
    )
