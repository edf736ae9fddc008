"""Date and time helpers over TIMESTAMP_NTZ / DATE columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

MINUTES_PER_DAY = 1440


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trip_day(ts: Column | str) -> Column:
    """Calendar date of a wall-clock timestamp (no zone shift for TIMESTAMP_NTZ)."""
    return _col(ts).cast("date")


def minute_index(ts: Column | str) -> Column:
    """Whole minutes since 1970-01-01 00:00 of a wall-clock timestamp.

    Built from the date and the clock fields only (``unix_date``, ``hour``,
    ``minute``), so it never passes through a time zone: a wall-clock time that
    falls in a daylight-saving gap of the session zone keeps its value.
    """
    t = _col(ts)
    return (
        F.unix_date(t.cast("date")).cast("bigint") * MINUTES_PER_DAY
        + F.hour(t) * 60
        + F.minute(t)
    )


def minute_boundaries_between(start: Column | str, end: Column | str) -> Column:
    """Number of minute boundaries crossed from ``start`` to ``end``.

    10:00:59 -> 10:01:00 is 1; 10:00:00 -> 10:00:59 is 0; 10:05:01 -> 10:00:59 is -5.
    Computed as the difference of whole-minute indexes, which is zone independent
    and stays inside whole-stage codegen.
    """
    return minute_index(end) - minute_index(start)


def month_window(year: Column | str, month: Column | str) -> tuple[Column, Column]:
    """(first day, last day) of a month as DATE columns."""
    first = F.make_date(_col(year), _col(month), F.lit(1))
    return first, F.last_day(first)


def month_window_values(year: int, month: int) -> tuple[str, str]:
    """Driver-side parameter form of :func:`month_window` (ISO text)."""
    first = dt.date(year, month, 1)
    nxt = dt.date(year + month // 12, month % 12 + 1, 1)
    return first.isoformat(), (nxt - dt.timedelta(days=1)).isoformat()


def previous_month(as_of: Column | None = None) -> Column:
    """First day of the month before ``as_of`` (default: today in the session zone)."""
    day = F.current_date() if as_of is None else as_of
    return F.add_months(F.trunc(day, "MM"), -1)


def zero_pad_month(month: Column | str) -> Column:
    """Month number as two-digit text (``4`` -> ``04``)."""
    return F.lpad(_col(month).cast("string"), 2, "0")


def yyyymm(day: Column | str) -> Column:
    """``YYYYMM`` text of a date, as used in landing file names."""
    return F.date_format(_col(day), "yyyyMM")


def iso_date_text(day: Column | str) -> Column:
    """``YYYY-MM-DD`` text of a date."""
    return F.date_format(_col(day), "yyyy-MM-dd")
