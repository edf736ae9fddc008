"""Explicit schemas for every table; nothing is inferred at scan time."""

from __future__ import annotations

from pyspark.sql import types as T

# Forced types of the trip CSV columns, in the order the operator lists them.
# Any other CSV column is kept as text.
TRIP_CSV_TYPES: dict[str, T.DataType] = {
    "ride_id": T.StringType(),
    "rideable_type": T.StringType(),
    "started_at": T.TimestampNTZType(),
    "ended_at": T.TimestampNTZType(),
    "start_station_name": T.StringType(),
    "start_station_id": T.StringType(),
    "end_station_name": T.StringType(),
    "end_station_id": T.StringType(),
    "start_lat": T.DoubleType(),
    "start_lng": T.DoubleType(),
    "end_lat": T.DoubleType(),
    "end_lng": T.DoubleType(),
    "member_casual": T.StringType(),
}

# Declared columns of the trip bronze table (extra CSV columns may follow).
TRIP_BRONZE_SCHEMA = T.StructType([T.StructField(n, t) for n, t in TRIP_CSV_TYPES.items()])

# Column order of the staged trip relation.
STAGED_TRIP_COLUMNS = [
    "ride_id",
    "rideable_type",
    "started_at",
    "ended_at",
    "start_station_id",
    "start_station_name",
    "end_station_id",
    "end_station_name",
    "start_lat",
    "start_lng",
    "end_lat",
    "end_lng",
    "member_casual",
]

WEATHER_MEASURES = [
    "temperature_max_c",
    "temperature_min_c",
    "precipitation_mm",
    "snowfall_mm",
    "avg_wind_speed_mps",
]

WEATHER_SCHEMA = T.StructType(
    [T.StructField("weather_date", T.DateType())]
    + [T.StructField(name, T.DoubleType()) for name in WEATHER_MEASURES]
)

HOLIDAY_SCHEMA = T.StructType(
    [
        T.StructField("holiday_date", T.DateType()),
        T.StructField("holiday_name", T.StringType()),
        T.StructField("is_holiday", T.BooleanType()),
    ]
)

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("pipeline_name", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("output_path", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("loaded_at", T.TimestampNTZType()),
    ]
)

# One landed page of daily observations: {"results": [{date, datatype, station, value}, ...]}
OBSERVATION_PAGE_SCHEMA = T.StructType(
    [
        T.StructField("page", T.LongType()),
        T.StructField(
            "results",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("date", T.StringType()),
                        T.StructField("datatype", T.StringType()),
                        T.StructField("station", T.StringType()),
                        T.StructField("attributes", T.StringType()),
                        T.StructField("value", T.DoubleType()),
                    ]
                )
            ),
        )
    ]
)

# Long-form observations after the page scan; ``seq`` orders rows for "first".
OBSERVATION_COLUMNS = ["obs_date", "datatype", "value", "seq"]

# Columns of a flow report frame (top flows); also the schema of an empty selection.
FLOW_REPORT_SCHEMA = T.StructType(
    [
        T.StructField("start_station_id", T.StringType()),
        T.StructField("start_station_name", T.StringType()),
        T.StructField("start_lat", T.DoubleType()),
        T.StructField("start_lng", T.DoubleType()),
        T.StructField("end_station_id", T.StringType()),
        T.StructField("end_station_name", T.StringType()),
        T.StructField("end_lat", T.DoubleType()),
        T.StructField("end_lng", T.DoubleType()),
        T.StructField("trip_count", T.LongType()),
        T.StructField("member_trips", T.LongType()),
        T.StructField("casual_trips", T.LongType()),
    ]
)
