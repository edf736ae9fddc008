"""Small numeric helpers used by reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def guarded_share(numerator: Column | str, denominator: Column | str) -> Column:
    """numerator / denominator, or 0.0 when the denominator is not positive."""
    num, den = _col(numerator), _col(denominator)
    return F.when(den > 0, num.cast("double") / den).otherwise(F.lit(0.0))


def flow_weight(trip_count: Column | str) -> Column:
    """Line weight of a flow on a map: trip_count / 20 clamped to [2, 8]."""
    return F.greatest(F.lit(2.0), F.least(F.lit(8.0), _col(trip_count) / F.lit(20.0)))
