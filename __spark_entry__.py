"""

``queries()`` maps each registered query to a callable ``(spark, sf_dir) ->
DataFrame`` (see ``velomart.catalog``).  ``oracle_sql()`` gives, for the same
oracle re-derives the trip, weather and ledger inputs from ``events`` and
``orders`` with the recipe of ``FIXTURES.md`` and then states each mart and
report independently in SQL.
"""

from __future__ import annotations

import importlib
import importlib.util
import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from velomart.catalog import LISTED_DAYS, QUERIES, RUSH_HOURS, SAMPLE_DAYS, SAMPLE_HOURS, WEEKEND_DAYS  # noqa: E402
from velomart.functions.calendar import DAY_NAMES  # noqa: E402
from velomart.operators.quality import ACCEPTED_VALUES, DECLARED_CHECKS, NOT_NULL, UNIQUE  # noqa: E402
from velomart.sources.seed import holiday_rows  # noqa: E402

FLAGSHIP_SF_DIR = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the enriched daily mart (trip facts -> daily aggregate -> weather
    pivot and holiday joins -> calendar context) on sf0.001."""
    return QUERIES["daily_enriched"](spark, FLAGSHIP_SF_DIR)


def _installed(*names: str) -> bool:
    """Whether all these modules are there, looked up without importing them."""
    for name in names:
        parent = name.rpartition(".")[0]
        if (parent and not _installed(parent)) or importlib.util.find_spec(name) is None:
            return False
    return True


def _training_data() -> tuple[dict, dict]:
    """Queries and oracle SQL of the training-data subpackage and its pipeline,
    both empty where they are not installed."""
    found, sql = {}, {}
    if _installed("velomart.llm.queries"):
        module = importlib.import_module("velomart.llm.queries")
        found, sql = dict(module.QUERIES), dict(module.ORACLE_SQL)
        if _installed("corpus_pipeline"):
            pipeline = importlib.import_module("corpus_pipeline")
            found["pipeline"] = pipeline.run
            if pipeline.ORACLE_SQL:
                sql["pipeline"] = pipeline.ORACLE_SQL
    return found, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**QUERIES, **_training_data()[0]}


# ---------------------------------------------------------------- oracle SQL


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in_list(values) -> str:
    return ", ".join(_q(v) if isinstance(v, str) else str(v) for v in values)


_SHIFT = "ts + to_days(cast(30 * (user_id % 12) + CASE WHEN user_id % 5 = 0 THEN 366 ELSE 0 END AS INTEGER))"
_RIDERS = """
    cast(sum(CASE WHEN member_casual = 'member' THEN 1 ELSE 0 END) AS BIGINT) AS member_trips,
    cast(sum(CASE WHEN member_casual = 'casual' THEN 1 ELSE 0 END) AS BIGINT) AS casual_trips"""
_HOUR = "cast(extract(hour FROM started_at) AS INTEGER)"
_BUCKET = f"""CASE
      WHEN {_HOUR} BETWEEN 6 AND 9 THEN 'Morning commute'
      WHEN {_HOUR} BETWEEN 10 AND 15 THEN 'Midday'
      WHEN {_HOUR} BETWEEN 16 AND 19 THEN 'Evening commute'
      ELSE 'Night / Early morning' END"""
_RUSH = f"""CASE WHEN {_HOUR} BETWEEN 6 AND 9 OR {_HOUR} BETWEEN 16 AND 19 THEN true ELSE false END"""


def _holiday_values() -> str:
    rows = ",\n      ".join(
        f"(DATE {_q(d)}, {_q(n)}, {'true' if f else 'false'})" for d, n, f in holiday_rows()
    )
    return f"SELECT * FROM (VALUES\n      {rows}) AS h(holiday_date, holiday_name, is_holiday)"


_FIXTURE_TRIPS = f"""SELECT
    cast(event_id AS VARCHAR) AS ride_id,
    CASE WHEN event_id % 3 = 0 THEN 'electric_bike' ELSE 'classic_bike' END AS rideable_type,
    {_SHIFT} AS started_at,
    {_SHIFT} + to_seconds(cast((event_id * 7919) % 7200 - 300 AS INTEGER)) AS ended_at,
    CASE WHEN event_id % 43 = 0 THEN NULL ELSE 'Station ' || cast(event_id % 17 AS VARCHAR) END AS start_station_name,
    CASE WHEN event_id % 41 = 0 THEN NULL ELSE 'S' || cast(event_id % 17 AS VARCHAR) END AS start_station_id,
    CASE WHEN event_id % 53 = 0 THEN NULL ELSE 'Station ' || cast(user_id % 11 AS VARCHAR) END AS end_station_name,
    CASE WHEN event_id % 47 = 0 THEN NULL ELSE 'S' || cast(user_id % 11 AS VARCHAR) END AS end_station_id,
    CASE WHEN event_id % 59 = 0 THEN NULL ELSE 40.5e0 + (event_id % 64) / 64.0e0 END AS start_lat,
    -74.25e0 + (event_id % 32) / 64.0e0 AS start_lng,
    40.5e0 + (user_id % 64) / 64.0e0 AS end_lat,
    CASE WHEN event_id % 61 = 0 THEN NULL ELSE -74.25e0 + (user_id % 32) / 64.0e0 END AS end_lng,
    CASE WHEN event_type IN ('purchase', 'signup') THEN 'member'
         WHEN event_type = 'error' THEN 'unknown' ELSE 'casual' END AS member_casual
  FROM events"""


def _ctes(trips_source: str | None = None) -> str:
    """Shared CTEs; ``trips_source`` replaces the fixture trips with a table of
    bronze-shaped trips (used by the randomized differential test)."""
    trips = f"SELECT * FROM {trips_source}" if trips_source else _FIXTURE_TRIPS
    return f"""
trips_raw AS (
  {trips}
),
stg AS (
  SELECT ride_id, rideable_type, cast(started_at AS TIMESTAMP) AS started_at,
         cast(ended_at AS TIMESTAMP) AS ended_at, start_station_id, start_station_name,
         end_station_id, end_station_name, start_lat, start_lng, end_lat, end_lng, member_casual
  FROM trips_raw
),
fct_trips AS (
  SELECT ride_id, rideable_type, started_at, ended_at,
         cast(date_trunc('day', started_at) AS DATE) AS trip_date,
         datediff('minute', started_at, ended_at) AS trip_duration_minutes,
         start_station_id, start_station_name, end_station_id, end_station_name, member_casual
  FROM stg
  WHERE ended_at >= started_at
),
trip_daily AS (
  SELECT trip_date, count(*) AS total_trips,{_RIDERS},
         avg(trip_duration_minutes) AS avg_trip_duration_minutes
  FROM fct_trips
  GROUP BY trip_date
),
obs AS (
  SELECT cast({_SHIFT} AS DATE) AS obs_date,
         CASE WHEN dayofmonth(cast({_SHIFT} AS DATE)) = 13 THEN 'TAVG' ELSE
           CASE event_id % 7 WHEN 0 THEN 'TMAX' WHEN 1 THEN 'TMIN' WHEN 2 THEN 'PRCP'
                WHEN 3 THEN 'SNOW' WHEN 4 THEN 'AWND' ELSE 'TAVG' END END AS datatype,
         value, event_id AS seq
  FROM events
),
weather AS (
  SELECT obs_date AS weather_date,
         min_by(value, seq) FILTER (WHERE datatype = 'TMAX') AS temperature_max_c,
         min_by(value, seq) FILTER (WHERE datatype = 'TMIN') AS temperature_min_c,
         min_by(value, seq) FILTER (WHERE datatype = 'PRCP') AS precipitation_mm,
         min_by(value, seq) FILTER (WHERE datatype = 'SNOW') AS snowfall_mm,
         min_by(value, seq) FILTER (WHERE datatype = 'AWND') AS avg_wind_speed_mps
  FROM obs
  WHERE datatype IN ('TMAX', 'TMIN', 'PRCP', 'SNOW', 'AWND') AND value IS NOT NULL
  GROUP BY obs_date
),
holidays AS (
  {_holiday_values()}
),
enriched AS (
  SELECT t.trip_date, t.total_trips, t.member_trips, t.casual_trips, t.avg_trip_duration_minutes,
         w.temperature_max_c, w.temperature_min_c, w.precipitation_mm, w.snowfall_mm, w.avg_wind_speed_mps,
         coalesce(h.is_holiday, false) AS is_holiday, h.holiday_name,
         extract(month FROM t.trip_date) AS month_number,
         strftime(t.trip_date, '%B') AS month_name,
         strftime(t.trip_date, '%A') AS day_name,
         CASE WHEN strftime(t.trip_date, '%w') IN ('0', '6') THEN true ELSE false END AS is_weekend,
         CASE WHEN extract(month FROM t.trip_date) IN (12, 1, 2) THEN 'Winter'
              WHEN extract(month FROM t.trip_date) IN (3, 4, 5) THEN 'Spring'
              WHEN extract(month FROM t.trip_date) IN (6, 7, 8) THEN 'Summer'
              ELSE 'Fall' END AS season
  FROM trip_daily t
  LEFT JOIN weather w ON t.trip_date = w.weather_date
  LEFT JOIN holidays h ON t.trip_date = h.holiday_date
),
station_daily AS (
  SELECT cast(started_at AS DATE) AS trip_date, start_station_id AS station_id,
         start_station_name AS station_name, avg(start_lat) AS lat, avg(start_lng) AS lon,
         count(*) AS trip_count,{_RIDERS}
  FROM stg
  WHERE start_station_id IS NOT NULL AND start_station_name IS NOT NULL
    AND start_lat IS NOT NULL AND start_lng IS NOT NULL
  GROUP BY 1, 2, 3
),
station_hourly AS (
  SELECT cast(started_at AS DATE) AS trip_date, {_HOUR} AS trip_hour,
         {_BUCKET} AS hour_bucket,
         {_RUSH} AS is_rush_hour,
         start_station_id AS station_id, start_station_name AS station_name,
         avg(start_lat) AS lat, avg(start_lng) AS lon, count(*) AS trip_count,{_RIDERS}
  FROM stg
  WHERE start_station_id IS NOT NULL AND start_station_name IS NOT NULL
    AND start_lat IS NOT NULL AND start_lng IS NOT NULL
  GROUP BY 1, 2, 3, 4, 5, 6
),
flows_daily AS (
  SELECT cast(started_at AS DATE) AS trip_date,
         start_station_id, start_station_name, avg(start_lat) AS start_lat, avg(start_lng) AS start_lng,
         end_station_id, end_station_name, avg(end_lat) AS end_lat, avg(end_lng) AS end_lng,
         count(*) AS trip_count,{_RIDERS}
  FROM stg
  WHERE start_station_id IS NOT NULL AND start_station_name IS NOT NULL
    AND end_station_id IS NOT NULL AND end_station_name IS NOT NULL
    AND start_lat IS NOT NULL AND start_lng IS NOT NULL
    AND end_lat IS NOT NULL AND end_lng IS NOT NULL
  GROUP BY 1, 2, 3, 6, 7
),
flows_hourly AS (
  SELECT cast(started_at AS DATE) AS trip_date, {_HOUR} AS trip_hour,
         {_BUCKET} AS hour_bucket,
         {_RUSH} AS is_rush_hour,
         start_station_id, start_station_name, avg(start_lat) AS start_lat, avg(start_lng) AS start_lng,
         end_station_id, end_station_name, avg(end_lat) AS end_lat, avg(end_lng) AS end_lng,
         count(*) AS trip_count,{_RIDERS}
  FROM stg
  WHERE start_station_id IS NOT NULL AND end_station_id IS NOT NULL
    AND start_station_id <> end_station_id
    AND start_lat IS NOT NULL AND start_lng IS NOT NULL
    AND end_lat IS NOT NULL AND end_lng IS NOT NULL
  GROUP BY 1, 2, 3, 4, 5, 6, 9, 10
),
requested AS (
  SELECT DISTINCT 'trips' AS pipeline_name,
         cast(year(o_orderdate) AS INTEGER) AS year, cast(month(o_orderdate) AS INTEGER) AS month
  FROM orders
),
ledger AS (
  SELECT pipeline_name, year, month,
         'bronze/trips/year=' || cast(year AS VARCHAR) || '/month=' || lpad(cast(month AS VARCHAR), 2, '0') AS output_path,
         CASE WHEN month % 2 = 0 THEN 'success' ELSE 'failed' END AS status,
         make_timestamp(year(make_date(year, month, 1) + INTERVAL 1 MONTH),
                        month(make_date(year, month, 1) + INTERVAL 1 MONTH), 5, 6, 0, 0) AS loaded_at
  FROM requested
  WHERE month % 2 = 0 OR month = 3
)"""


def _with(body: str, trips_source: str | None = None) -> str:
    return f"WITH {_ctes(trips_source)}\n{body}"


_FLOW_COLS = (
    "start_station_id, start_station_name, start_lat, start_lng, "
    "end_station_id, end_station_name, end_lat, end_lng"
)
_FLOW_SUMS = """cast(sum(trip_count) AS BIGINT) AS trip_count,
       cast(sum(member_trips) AS BIGINT) AS member_trips,
       cast(sum(casual_trips) AS BIGINT) AS casual_trips"""
_ALL_DAYS = "trip_date IN (SELECT trip_date FROM enriched)"


def _rounded(source: str, columns: tuple[str, ...]) -> str:
    """``source`` with mean coordinates as group keys of 6 decimal places."""
    return f"(SELECT * REPLACE ({', '.join(f'round({c}, 6) AS {c}' for c in columns)}) FROM {source}) AS r"


_ROUNDED_FLOWS = _rounded("flows_daily", ("start_lat", "start_lng", "end_lat", "end_lng"))


def _nulls_last(cols: str) -> str:
    return ", ".join(f"{c.strip()} ASC NULLS LAST" for c in cols.split(","))


def _hour_filter(h) -> str:
    cond = f"trip_hour BETWEEN {h.start_hour} AND {h.end_hour}"
    cond += f" AND hour_bucket IN ({_in_list(h.hour_buckets)})" if h.hour_buckets else " AND false"
    if h.rush == "Rush hours only":
        cond += " AND is_rush_hour = true"
    elif h.rush == "Non-rush hours only":
        cond += " AND is_rush_hour = false"
    return cond


def _default_hours():
    from velomart.operators.reports import HourFilters

    return HourFilters()


def _sample_days_filter(f=SAMPLE_DAYS, weekend: bool = False) -> str:
    conds = [
        f"trip_date >= DATE {_q(f.start_date)}",
        f"trip_date <= DATE {_q(f.end_date)}",
        f"season IN ({_in_list(f.seasons)})",
        f"day_name IN ({_in_list(f.day_names)})",
        f"year(trip_date) IN ({_in_list(f.years)})",
        f"month_name IN ({_in_list(f.month_names)})",
        "is_holiday = false",
        f"is_weekend = {'true' if weekend else 'false'}",
    ]
    return " AND ".join(conds)


_STATION_KEYS = "station_id, station_name, lat, lon"
_STATION_NOT_MISSING = (
    "station_id IS NOT NULL AND station_name IS NOT NULL AND lat IS NOT NULL AND NOT isnan(lat) "
    "AND lon IS NOT NULL AND NOT isnan(lon)"
)


def _station_activity(source: str, where: str, limit: int, cols: str = "") -> str:
    return f"""
SELECT {cols or _STATION_KEYS + ','} {_FLOW_SUMS}
FROM {_rounded(source, ("lat", "lon"))}
WHERE {where} AND {_STATION_NOT_MISSING}
GROUP BY {_STATION_KEYS}
ORDER BY trip_count DESC, {_nulls_last(_STATION_KEYS)}
LIMIT {limit}"""


_CHECK_CTE = {
    "stg_trips": "stg",
    "stg_weather_daily": "weather",
    "fct_trips": "fct_trips",
    "fct_trip_daily": "trip_daily",
    "fct_trip_daily_enriched": "enriched",
    "fct_station_daily": "station_daily",
    "fct_station_flows_daily": "flows_daily",
    "fct_station_hourly": "station_hourly",
    "fct_station_flows_hourly": "flows_hourly",
    "holiday_calendar": "holidays",
}


def _check_sql(c) -> str:
    src, col = _CHECK_CTE[c.table], c.column
    head = f"SELECT {_q(c.table)} AS table_name, {_q(col)} AS column_name, {_q(c.kind)} AS check_name"
    if c.kind == NOT_NULL:
        return f"{head}, cast(count(*) FILTER (WHERE {col} IS NULL) AS BIGINT) AS failures FROM {src}"
    if c.kind == UNIQUE:
        inner = f"SELECT {col} FROM {src} WHERE {col} IS NOT NULL GROUP BY {col} HAVING count(*) > 1"
    else:
        inner = (
            f"SELECT {col} FROM {src} WHERE {col} IS NOT NULL AND {col} NOT IN ({_in_list(c.values)}) "
            f"GROUP BY {col}"
        )
    return f"{head}, cast(count(*) AS BIGINT) AS failures FROM ({inner}) AS g"


def _failing_values_sql(kind: str) -> str:
    parts = []
    for c in DECLARED_CHECKS:
        if c.kind != kind:
            continue
        src, col = _CHECK_CTE[c.table], c.column
        cond = f"{col} IS NOT NULL"
        having = ""
        if kind == UNIQUE:
            having = " HAVING count(*) > 1"
        else:
            cond += f" AND {col} NOT IN ({_in_list(c.values)})"
        parts.append(
            f"SELECT {_q(c.table)} AS table_name, {_q(col)} AS column_name, cast({col} AS VARCHAR) AS value, "
            f"count(*) AS n_records FROM {src} WHERE {cond} GROUP BY {col}{having}"
        )
    return "\nUNION ALL\n".join(parts)


def _weather_select(where: str = "") -> str:
    return f"""
SELECT obs_date AS weather_date,
       min_by(value, seq) FILTER (WHERE datatype = 'TMAX') AS temperature_max_c,
       min_by(value, seq) FILTER (WHERE datatype = 'TMIN') AS temperature_min_c,
       min_by(value, seq) FILTER (WHERE datatype = 'PRCP') AS precipitation_mm,
       min_by(value, seq) FILTER (WHERE datatype = 'SNOW') AS snowfall_mm,
       min_by(value, seq) FILTER (WHERE datatype = 'AWND') AS avg_wind_speed_mps
FROM obs
WHERE datatype IN ('TMAX', 'TMIN', 'PRCP', 'SNOW', 'AWND') AND value IS NOT NULL {where}
GROUP BY obs_date"""


def _day_order() -> str:
    whens = " ".join(f"WHEN {_q(n)} THEN {i}" for i, n in enumerate(DAY_NAMES, start=1))
    return f"cast(CASE day_name {whens} END AS INTEGER)"


#: Queries over other trips than the fixture's: some rides twice; complete rides only.
_REPEATED_TRIPS = f"({_FIXTURE_TRIPS} UNION ALL {_FIXTURE_TRIPS} WHERE event_id % 499 = 0) AS t"
_COMPLETE_TRIPS = f"""(SELECT * FROM ({_FIXTURE_TRIPS}) AS f WHERE member_casual IN ('member', 'casual')
  AND start_station_name IS NOT NULL AND start_station_id IS NOT NULL AND end_station_name IS NOT NULL
  AND end_station_id IS NOT NULL AND start_lat IS NOT NULL AND end_lng IS NOT NULL) AS t"""
_TRIPS_OF = {
    "quality_report": _REPEATED_TRIPS,
    "quality_duplicates": _REPEATED_TRIPS,
    "quality_unexpected": _REPEATED_TRIPS,
    "quality_after_refresh": _REPEATED_TRIPS,
    "monthly_load_marts": _COMPLETE_TRIPS,
}


def oracle_sql() -> dict[str, str]:
    reference = {name: _with(body, _TRIPS_OF.get(name)) for name, body in _bodies().items() if name in QUERIES}
    return {**reference, **_training_data()[1]}


def _versions_sql() -> str:
    """Rows by mart and month: of all trips, and with the members' trips of one month alone."""
    march = "trip_date >= DATE '2024-03-01' AND trip_date < DATE '2024-04-01'"
    stored = {"fct_trips": "fct_trips", "fct_trip_daily": "trip_daily", "fct_trip_daily_enriched": "trip_daily"}
    stored |= {f"fct_{t}": t for t in ("station_daily", "station_hourly")}
    stored |= {f"fct_station_{t}": t for t in ("flows_daily", "flows_hourly")}
    parts = []
    for mart, table in stored.items():
        if mart == "fct_trips":
            members = "member_casual = 'member'"
        elif mart.startswith("fct_trip_daily"):
            members = "trip_date IN (SELECT trip_date FROM fct_trips WHERE member_casual = 'member')"
        else:
            members = "member_trips > 0"
        for version, kept in ((1, "true"), (2, f"(NOT ({march}) OR {members})")):
            parts.append(
                f"SELECT cast({version} AS BIGINT) AS version, '{mart}' AS mart, "
                f"cast(date_trunc('month', trip_date) AS DATE) AS trip_month, count(*) AS n_rows FROM {table} WHERE {kept} GROUP BY 3"
            )
    return "\nUNION ALL\n".join(parts)


def _bodies() -> dict[str, str]:
    """The final SELECT of every query (to be prefixed with the shared CTEs)."""
    all_hours = _default_hours()
    hourly_sel = f"FROM station_hourly WHERE {_ALL_DAYS} AND {_hour_filter(all_hours)}"
    top_daily = f"""
SELECT {_FLOW_COLS}, {_FLOW_SUMS}
FROM {_ROUNDED_FLOWS}
WHERE {_ALL_DAYS}
GROUP BY {_FLOW_COLS}
ORDER BY trip_count DESC, {_nulls_last(_FLOW_COLS)}
LIMIT 100"""
    hourly_keys = "start_station_id, start_station_name, end_station_id, end_station_name"
    checks = "\nUNION ALL\n".join(_check_sql(c) for c in DECLARED_CHECKS)
    sql = {
        "stage_trips": "SELECT * FROM stg",
        "trip_facts": "SELECT * FROM fct_trips",
        "trip_daily": "SELECT * FROM trip_daily",
        "station_daily": "SELECT * FROM station_daily",
        "station_hourly": "SELECT * FROM station_hourly",
        "flows_daily": "SELECT * FROM flows_daily",
        "flows_hourly": "SELECT * FROM flows_hourly",
        "weather_pivot": "SELECT * FROM weather",
        "stage_weather": "SELECT * FROM weather",
        "daily_enriched": "SELECT * FROM enriched",
        "holiday_days": """
SELECT trip_date AS holiday_date, holiday_name, is_holiday, total_trips, member_trips, casual_trips
FROM enriched WHERE is_holiday = true""",
        "kpis": """
SELECT cast(sum(total_trips) AS BIGINT) AS total_trips,
       round(avg(total_trips), 6) AS avg_daily_trips,
       round(avg(avg_trip_duration_minutes), 6) AS avg_trip_duration_minutes,
       CASE WHEN sum(member_trips) + sum(casual_trips) > 0
            THEN cast(sum(member_trips) AS DOUBLE) / cast(sum(member_trips) + sum(casual_trips) AS DOUBLE)
            ELSE 0.0e0 END AS member_share,
       (SELECT trip_date FROM enriched ORDER BY total_trips DESC, trip_date ASC LIMIT 1) AS busiest_day,
       max(total_trips) AS busiest_day_trips
FROM enriched""",
        "date_bounds": "SELECT min(trip_date) AS min_date, max(trip_date) AS max_date FROM enriched",
        "season_options": "SELECT DISTINCT season FROM enriched WHERE season IS NOT NULL",
        "year_options": "SELECT DISTINCT cast(year(trip_date) AS INTEGER) AS year FROM enriched",
        "filtered_days": f"SELECT * FROM enriched WHERE {_sample_days_filter()}",
        "weekday_profile": f"""
SELECT day_name, {_day_order()} AS day_order, round(avg(total_trips), 6) AS avg_total_trips
FROM enriched WHERE day_name IS NOT NULL GROUP BY day_name""",
        "weather_scatter": """
SELECT trip_date, total_trips, temperature_max_c, season FROM enriched
WHERE trip_date IS NOT NULL AND total_trips IS NOT NULL AND temperature_max_c IS NOT NULL
  AND NOT isnan(temperature_max_c) AND season IS NOT NULL""",
        "top_flows_daily": top_daily,
        "daily_series": "SELECT trip_date, total_trips, member_trips, casual_trips FROM enriched",
        "listed_days_flows": f"""
SELECT {_FLOW_COLS}, {_FLOW_SUMS}
FROM {_ROUNDED_FLOWS}
WHERE trip_date IN (SELECT trip_date FROM enriched
                    WHERE trip_date IN ({", ".join(f"DATE {_q(d)}" for d in LISTED_DAYS.dates)}))
GROUP BY {_FLOW_COLS}
ORDER BY trip_count DESC, {_nulls_last(_FLOW_COLS)}
LIMIT 100""",
        "flow_map_daily": f"""
SELECT start_station_name AS origin_station, end_station_name AS destination_station,
       trip_count, member_trips, casual_trips,
       greatest(2.0e0, least(8.0e0, trip_count / 20.0e0)) AS line_weight
FROM ({top_daily}) AS t""",
        "top_flows_hourly": f"""
SELECT start_station_id, start_station_name,
       round(avg(start_lat), 6) AS start_lat, round(avg(start_lng), 6) AS start_lng,
       end_station_id, end_station_name,
       round(avg(end_lat), 6) AS end_lat, round(avg(end_lng), 6) AS end_lng,
       {_FLOW_SUMS}
FROM flows_hourly
WHERE {_ALL_DAYS} AND {_hour_filter(SAMPLE_HOURS)}
GROUP BY {hourly_keys}
ORDER BY trip_count DESC, {_nulls_last(hourly_keys)}
LIMIT 100""",
        "empty_selection": top_daily,
        "filtered_weekends": f"SELECT * FROM enriched WHERE {_sample_days_filter(WEEKEND_DAYS, weekend=True)}",
        "rush_hour_trips": f"""
SELECT trip_hour, cast(sum(trip_count) AS BIGINT) AS trip_count
FROM station_hourly
WHERE {_ALL_DAYS} AND trip_hour BETWEEN {RUSH_HOURS.start_hour} AND {RUSH_HOURS.end_hour} AND is_rush_hour
  AND trip_hour IS NOT NULL
GROUP BY trip_hour""",
        "station_activity_daily": _station_activity("station_daily", _ALL_DAYS, 300),
        "station_table_daily": _station_activity(
            "station_daily", _ALL_DAYS, 15, cols="station_name,"
        ),
        "station_activity_hourly": _station_activity(
            "station_hourly", f"{_ALL_DAYS} AND {_hour_filter(SAMPLE_HOURS)}", 300
        ),
        "hourly_trips": f"""
SELECT trip_hour, cast(sum(trip_count) AS BIGINT) AS trip_count {hourly_sel} AND trip_hour IS NOT NULL
GROUP BY trip_hour""",
        "hourly_rider_mix": f"""
SELECT trip_hour, 'member_trips' AS rider_type, cast(sum(member_trips) AS BIGINT) AS trip_count
{hourly_sel} AND trip_hour IS NOT NULL GROUP BY trip_hour
UNION ALL
SELECT trip_hour, 'casual_trips' AS rider_type, cast(sum(casual_trips) AS BIGINT) AS trip_count
{hourly_sel} AND trip_hour IS NOT NULL GROUP BY trip_hour""",
        "bucket_trips": f"""
SELECT hour_bucket, cast(sum(trip_count) AS BIGINT) AS trip_count {hourly_sel} AND hour_bucket IS NOT NULL
GROUP BY hour_bucket""",
        "hourly_leaders": f"""
SELECT station_name, {_FLOW_SUMS} {hourly_sel} AND station_name IS NOT NULL
GROUP BY station_name ORDER BY trip_count DESC, station_name LIMIT 15""",
        "top_days": """
SELECT trip_date AS date, total_trips, member_trips, casual_trips, avg_trip_duration_minutes,
       holiday_name, temperature_max_c
FROM enriched ORDER BY total_trips DESC, trip_date ASC LIMIT 10""",
        "month_windows": """
SELECT year, month, as_of, cast(year(load) AS INTEGER) AS load_year, cast(month(load) AS INTEGER) AS load_month,
       load AS month_start, last_day(load) AS month_end,
       lpad(cast(month(load) AS VARCHAR), 2, '0') AS month_text, strftime(load, '%Y%m') AS period
FROM (SELECT year, month, make_date(year, month, 5) AS as_of,
             cast(make_date(year, month, 1) - INTERVAL 1 MONTH AS DATE) AS load
      FROM requested) AS m""",
        "pending_months": """
SELECT r.pipeline_name, r.year, r.month FROM requested r
WHERE NOT EXISTS (SELECT 1 FROM ledger l WHERE l.status = 'success' AND l.pipeline_name = r.pipeline_name
                  AND l.year = r.year AND l.month = r.month)""",
        "quality_report": f"SELECT *, failures = 0 AS passed FROM (\n{checks}\n) AS c",
        "quality_after_refresh": f"SELECT *, failures = 0 AS passed FROM (\n{checks}\n) AS c",
        "marts_by_version": _versions_sql(),
        "quality_duplicates": _failing_values_sql(UNIQUE),
        "quality_unexpected": _failing_values_sql(ACCEPTED_VALUES),
        "weather_window": _weather_select("AND obs_date BETWEEN DATE '2024-02-01' AND DATE '2024-02-29'"),
        "csv_union_roundtrip": """
SELECT ride_id, rideable_type, started_at, ended_at, start_station_name, start_station_id,
       end_station_name, end_station_id, start_lat, start_lng, end_lat, end_lng, member_casual,
       CASE WHEN month(started_at) > 6 THEN 'R' || ride_id END AS rental_access_method,
       CASE WHEN month(started_at) > 6 THEN cast(length(start_station_name) AS BIGINT) END AS name_length,
       CASE WHEN month(started_at) > 6 THEN start_lat * 2 END AS double_lat,
       CASE WHEN month(started_at) > 6 THEN cast(started_at AS DATE) END AS service_day,
       CASE WHEN month(started_at) > 6 THEN member_casual = 'member' END AS is_member
FROM trips_raw""",
        "json_observations": "SELECT * FROM weather",
        "bronze_roundtrip": "SELECT * FROM stg",
        "ledger_roundtrip": "SELECT * FROM ledger",
        "ledger_compacted": "SELECT * FROM ledger",
        "ledger_lookup": """
SELECT r.pipeline_name, r.year, r.month, count(l.pipeline_name) > 0 AS already_loaded, count(l.pipeline_name) AS loads
FROM requested r LEFT JOIN ledger l
  ON l.status = 'success' AND l.pipeline_name = r.pipeline_name AND l.year = r.year AND l.month = r.month
GROUP BY r.pipeline_name, r.year, r.month""",
        "monthly_load_marts": """
SELECT e.trip_date, e.total_trips, e.member_trips, e.casual_trips, e.avg_trip_duration_minutes,
       e.temperature_max_c, e.season, w.temperature_min_c AS staged_min_c,
       cast(CASE month(e.trip_date) WHEN 3 THEN 1 ELSE 2 END AS BIGINT) AS trip_loads
FROM enriched e LEFT JOIN weather w ON w.weather_date = e.trip_date
WHERE e.trip_date BETWEEN DATE '2024-03-01' AND DATE '2024-04-30'""",
        "mart_roundtrip": "SELECT * FROM station_daily",
        "csv_export_roundtrip": "SELECT * FROM enriched",
    }
    missing = set(QUERIES) - set(sql)
    assert not missing, f"queries without oracle: {sorted(missing)}"
    return sql

