"""SQL access: temp views over staging relations and stored marts.

Staging relations are views (no data stored): their definition is inlined
into every query that reads them.  Marts are stored tables.  After
``register_views`` a report can be written in plain Spark SQL, e.g.
``spark.sql("select * from fct_station_daily order by trip_date, trip_count desc")``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velomart.operators import marts
from velomart.operators.joins import TRIP_MONTH
from velomart.operators.staging import stage_trips, stage_weather
from velomart.plans.build import load_marts
from velomart.plans.ingest import Layout
from velomart.sources.seed import read_holidays
from velomart.sources.tables import read_bronze_trips, read_bronze_weather


def register_views(spark: SparkSession, layout: Layout) -> list[str]:
    """Create temp views for staging, the seed and every stored mart."""
    views = {
        "stg_trips": stage_trips(read_bronze_trips(spark, layout.trips_bronze)),
        "stg_weather_daily": stage_weather(read_bronze_weather(spark, layout.weather_bronze)),
        "holiday_calendar": read_holidays(spark, layout.seed),
    }
    for name, stored in load_marts(spark, layout).items():
        views[name] = stored.drop(TRIP_MONTH)
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)


def read_ordered_mart(spark: SparkSession, layout: Layout, name: str) -> DataFrame:
    """A stored mart in its declared order (date, [hour], count desc).

    The order is applied here, at the reader, because a distributed table has
    no row order of its own.
    """
    stored = load_marts(spark, layout)[name]
    columns = [c for c in stored.columns if c != TRIP_MONTH]
    return stored.select(*[F.col(c) for c in columns]).orderBy(*marts.mart_sort_keys(name))
