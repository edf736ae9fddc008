"""Calendar enrichment of a day: month number/name, day name, weekend, season."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# English month and day names, in calendar order.
MONTH_NAMES = [
    "January",
    "February",
    "March",
    "April",
    "May",
    "June",
    "July",
    "August",
    "September",
    "October",
    "November",
    "December",
]
DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

# Meteorological seasons by month number; any other month is Fall.
WINTER_MONTHS = [12, 1, 2]
SPRING_MONTHS = [3, 4, 5]
SUMMER_MONTHS = [6, 7, 8]
SEASONS = ["Fall", "Spring", "Summer", "Winter"]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_number(day: Column | str) -> Column:
    """Month of the date as BIGINT (1-12)."""
    return F.month(_col(day)).cast("bigint")


def month_name(day: Column | str) -> Column:
    return F.date_format(_col(day), "MMMM")


def day_name(day: Column | str) -> Column:
    return F.date_format(_col(day), "EEEE")


def is_weekend(day: Column | str) -> Column:
    """Saturday or Sunday (``dayofweek`` is 1 for Sunday, 7 for Saturday)."""
    return F.coalesce(F.dayofweek(_col(day)).isin(1, 7), F.lit(False))


def season(day: Column | str) -> Column:
    m = F.month(_col(day))
    return (
        F.when(m.isin(*WINTER_MONTHS), "Winter")
        .when(m.isin(*SPRING_MONTHS), "Spring")
        .when(m.isin(*SUMMER_MONTHS), "Summer")
        .otherwise("Fall")
    )
