"""Holiday seed: a small CSV dimension with a declared schema."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame, SparkSession

from velomart.schemas import HOLIDAY_SCHEMA

HOLIDAY_SEED_PATH = os.path.join(os.path.dirname(os.path.dirname(__file__)), "seeds", "holiday_calendar.csv")

def holiday_rows(path: str | None = None) -> list[tuple[str, str, bool]]:
    """The shipped seed rows as plain values (date text, name, flag)."""
    with open(path or HOLIDAY_SEED_PATH, encoding="utf-8") as fh:
        lines = [ln.rstrip("\n") for ln in fh if ln.strip() and not ln.startswith("#")]
    rows = []
    for line in lines[1:]:
        day, name, flag = line.split(",")
        rows.append((day, name, flag.strip().lower() == "true"))
    return rows


def read_holidays(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Typed holiday dimension (holiday_date DATE, holiday_name, is_holiday BOOLEAN).

    With ``path`` (a seed CSV on shared storage) the file is scanned with the
    declared schema; a malformed row fails the read.  Without it the seed shipped
    in the package is used: 33 rows, so they are handed to Spark directly and no
    executor needs the package's data files.
    """
    if path is not None:
        return (
            spark.read.schema(HOLIDAY_SCHEMA)
            .option("header", True)
            .option("comment", "#")
            .option("mode", "FAILFAST")
            .csv(path)
        )
    rows = [(dt.date.fromisoformat(d), n, f) for d, n, f in holiday_rows()]
    return spark.createDataFrame(rows, HOLIDAY_SCHEMA)


def write_seed_csv(spark: SparkSession, path: str) -> str:
    """Publish the shipped seed as one CSV file under ``path`` (shared storage)."""
    read_holidays(spark).coalesce(1).write.mode("overwrite").option("header", True).option(
        "dateFormat", "yyyy-MM-dd"
    ).csv(path)
    return path
