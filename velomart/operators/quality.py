"""Data-quality checks: not_null, unique, accepted_values, report and gate.

All not-null checks of one table run in a single pass (one ``agg`` of
``count_if(col IS NULL)`` per column).  A unique check is a grouped count with
partial aggregation, so a heavily duplicated value collapses map-side.  Only
the report (one row per declared check) ever reaches the driver, in the gate.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from velomart.functions.daypart import HOUR_BUCKETS

NOT_NULL, UNIQUE, ACCEPTED_VALUES = "not_null", "unique", "accepted_values"


@dataclass(frozen=True)
class Check:
    table: str
    column: str
    kind: str
    values: tuple[str, ...] = ()


class DataQualityError(RuntimeError):
    """Raised by :func:`assert_checks_pass` when a declared check fails."""


def _nn(table: str, *columns: str) -> list[Check]:
    return [Check(table, c, NOT_NULL) for c in columns]


RIDER_TYPES = ("member", "casual")

# The declared checks, table by table (59 in total).
DECLARED_CHECKS: list[Check] = [
    *_nn("stg_trips", "ride_id", "started_at", "ended_at", "member_casual"),
    Check("stg_trips", "ride_id", UNIQUE),
    Check("stg_trips", "member_casual", ACCEPTED_VALUES, RIDER_TYPES),
    *_nn("stg_weather_daily", "weather_date"),
    Check("stg_weather_daily", "weather_date", UNIQUE),
    *_nn("fct_trips", "ride_id", "trip_date"),
    Check("fct_trips", "ride_id", UNIQUE),
    *_nn(
        "fct_trip_daily",
        "trip_date",
        "total_trips",
        "member_trips",
        "casual_trips",
        "avg_trip_duration_minutes",
    ),
    Check("fct_trip_daily", "trip_date", UNIQUE),
    *_nn("fct_trip_daily_enriched", "trip_date"),
    Check("fct_trip_daily_enriched", "trip_date", UNIQUE),
    *_nn("fct_station_daily", "trip_date", "station_id", "lat", "lon", "trip_count"),
    *_nn("fct_station_flows_daily", "trip_date", "start_station_id", "end_station_id", "trip_count"),
    *_nn(
        "fct_station_hourly",
        "trip_date",
        "trip_hour",
        "hour_bucket",
        "is_rush_hour",
        "station_id",
        "station_name",
        "lat",
        "lon",
        "trip_count",
        "member_trips",
        "casual_trips",
    ),
    Check("fct_station_hourly", "hour_bucket", ACCEPTED_VALUES, tuple(HOUR_BUCKETS)),
    *_nn(
        "fct_station_flows_hourly",
        "trip_date",
        "trip_hour",
        "hour_bucket",
        "is_rush_hour",
        "start_station_id",
        "start_station_name",
        "end_station_id",
        "end_station_name",
        "start_lat",
        "start_lng",
        "end_lat",
        "end_lng",
        "trip_count",
        "member_trips",
        "casual_trips",
    ),
    Check("fct_station_flows_hourly", "hour_bucket", ACCEPTED_VALUES, tuple(HOUR_BUCKETS)),
    *_nn("holiday_calendar", "holiday_date", "holiday_name"),
    Check("holiday_calendar", "holiday_date", UNIQUE),
]

REPORT_COLUMNS = ["table_name", "column_name", "check_name", "failures", "passed"]


def _by_table(checks: Iterable[Check]) -> dict[str, list[Check]]:
    grouped: dict[str, list[Check]] = {}
    for c in checks:
        grouped.setdefault(c.table, []).append(c)
    return grouped


def _row(check: Check, failures) -> F.Column:
    return F.struct(
        F.lit(check.table).alias("table_name"),
        F.lit(check.column).alias("column_name"),
        F.lit(check.kind).alias("check_name"),
        failures.cast("bigint").alias("failures"),
    )


def _duplicate_groups(df: DataFrame, column: str) -> DataFrame:
    """Values of ``column`` seen more than once (nulls ignored), with their counts."""
    return (
        df.select(F.col(column).alias("value"))
        .where(F.col("value").isNotNull())
        .groupBy("value")
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def _duplicate_groups_across(df: DataFrame, rest: DataFrame, column: str) -> DataFrame:
    """Values of ``column`` in ``df`` seen more than once in ``df`` and ``rest`` together.

    This is the unique check of a table split in a checked slice (``df``) and a
    rest that passed before: a value duplicated only within the rest cannot have
    changed.  Both sides go through one exchange; the partial aggregation below
    it collapses a heavily repeated value map-side, like the plain check.
    """
    value = F.col("value")
    tagged = df.select(F.col(column).alias("value"), F.lit(True).alias("in_slice")).unionByName(
        # Only ids that the slice has go into the grouping: the join's build side is the
        # slice, of which Spark sends a Bloom filter to the scan of the rest.
        rest.select(F.col(column).alias("value")).join(df.select(F.col(column).alias("value")), "value", "left_semi").select("value", F.lit(False).alias("in_slice"))
    )
    return (
        tagged.where(value.isNotNull())
        .groupBy("value")
        .agg(F.count(F.lit(1)).alias("n_records"), F.bool_or("in_slice").alias("in_slice"))
        .where((F.col("n_records") > 1) & F.col("in_slice"))
        .drop("in_slice")
    )


def _unique_groups(tables: dict[str, DataFrame], rest: dict[str, DataFrame] | None, check: Check) -> DataFrame:
    df = tables[check.table]
    if rest and check.table in rest:
        return _duplicate_groups_across(df, rest[check.table], check.column)
    return _duplicate_groups(df, check.column)


def _unexpected_groups(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Non-null values of ``column`` outside ``values``, with their counts."""
    v = F.col("value")
    return (
        df.select(F.col(column).alias("value"))
        .where(v.isNotNull() & ~v.isin(*values))
        .groupBy("value")
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def check_results(
    tables: dict[str, DataFrame],
    checks: Sequence[Check] = DECLARED_CHECKS,
    rest: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """One row per check: table_name, column_name, check_name, failures, passed.

    ``failures`` is the number of null rows (not_null), of duplicated values
    (unique) or of distinct unexpected values (accepted_values).  ``rest`` maps a
    table to the rows outside the checked slice (a month refresh): its unique
    checks then also count values shared between the slice and the rest, so the
    report equals the whole-table one whenever the rest passed before.
    """
    parts: list[DataFrame] = []
    for table, group in _by_table(checks).items():
        df = tables[table]
        not_null = [c for c in group if c.kind == NOT_NULL]
        if not_null:
            rows = [_row(c, F.count_if(F.col(c.column).isNull())) for c in not_null]
            parts.append(df.agg(F.array(*rows).alias("r")).select(F.inline("r")))
        for c in group:
            if c.kind == UNIQUE:
                groups = _unique_groups(tables, rest, c)
            elif c.kind == ACCEPTED_VALUES:
                groups = _unexpected_groups(df, c.column, c.values)
            else:
                continue
            parts.append(groups.agg(F.array(_row(c, F.count(F.lit(1)))).alias("r")).select(F.inline("r")))
    report = reduce(DataFrame.unionByName, parts)
    return report.withColumn("passed", F.col("failures") == 0).select(*REPORT_COLUMNS)


def duplicate_values(
    tables: dict[str, DataFrame],
    checks: Sequence[Check] = DECLARED_CHECKS,
    rest: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Failing rows of the unique checks: table_name, column_name, value, n_records."""
    parts = [
        _unique_groups(tables, rest, c).select(
            F.lit(c.table).alias("table_name"),
            F.lit(c.column).alias("column_name"),
            F.col("value").cast("string").alias("value"),
            "n_records",
        )
        for c in checks
        if c.kind == UNIQUE
    ]
    return reduce(DataFrame.unionByName, parts)


def unexpected_values(tables: dict[str, DataFrame], checks: Sequence[Check] = DECLARED_CHECKS) -> DataFrame:
    """Failing rows of the accepted_values checks: table_name, column_name, value, n_records."""
    parts = [
        _unexpected_groups(tables[c.table], c.column, c.values).select(
            F.lit(c.table).alias("table_name"),
            F.lit(c.column).alias("column_name"),
            F.col("value").cast("string").alias("value"),
            "n_records",
        )
        for c in checks
        if c.kind == ACCEPTED_VALUES
    ]
    return reduce(DataFrame.unionByName, parts)


def collect_check_results(
    tables: dict[str, DataFrame],
    checks: Sequence[Check] = DECLARED_CHECKS,
    concurrent_jobs: int = 8,
    rest: dict[str, DataFrame] | None = None,
) -> list[Row]:
    """The check report as rows, one Spark job per table run concurrently.

    The report holds one row per declared check, so collecting it is bounded.
    """
    grouped = _by_table(checks)

    def one(table: str) -> list[Row]:
        table_rest = {table: rest[table]} if rest and table in rest else None
        return check_results({table: tables[table]}, grouped[table], table_rest).collect()

    with ThreadPoolExecutor(max_workers=max(1, min(concurrent_jobs, len(grouped)))) as pool:
        parts = list(pool.map(one, grouped))
    return [row for part in parts for row in part]


def checks_for(tables: Iterable[str], checks: Sequence[Check] = DECLARED_CHECKS) -> list[Check]:
    wanted = set(tables)
    return [c for c in checks if c.table in wanted]


def assert_checks_pass(report: DataFrame | list[Row]) -> None:
    """Gate: raise :class:`DataQualityError` if any check failed.

    The report has one row per declared check, so collecting its failing rows
    is bounded by the number of checks.
    """
    if isinstance(report, DataFrame):
        failing = report.where(~F.col("passed")).collect()
    else:
        failing = [r for r in report if not r.passed]
    if failing:
        lines = [f"{r.table_name}.{r.column_name} {r.check_name}: {r.failures} failures" for r in failing]
        raise DataQualityError("data quality checks failed:\n" + "\n".join(lines))
