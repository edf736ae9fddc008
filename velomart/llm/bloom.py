"""A Bloom filter of a fixed number of bits.

What a task keeps by it is never decided by it alone: a value that passes goes on
to an exact join, so a full filter costs time, not rows.  Its size is a constant,
which bounds what is sent to the driver and broadcast, however many values it holds.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS_LOG2 = 23  # 1 MiB


def build(values: DataFrame, column: str, bits_log2: int = BITS_LOG2) -> np.ndarray:
    """The filter of a column of 64-bit integers: bits are combined by Spark, at
    most ``2**bits_log2 / 32`` words of them reach the driver."""
    v = F.col(column)
    mask = F.lit((1 << bits_log2) - 1)
    bit = F.explode(F.array(v.bitwiseAND(mask), F.shiftrightunsigned(v, 32).bitwiseAND(mask)))
    words = (
        values.where(v.isNotNull())
        .select(bit.alias("b"))
        .select(F.shiftright("b", 5).alias("w"), F.expr("shiftleft(1L, cast(b & 31 as int))").alias("m"))
        .groupBy("w")
        .agg(F.bit_or("m").alias("m"))
    )
    out = np.zeros(1 << (bits_log2 - 5), np.uint32)
    got = words.toArrow()
    out[got["w"].to_numpy()] = got["m"].to_numpy().astype(np.uint32)
    return out


def passes(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which of the 64-bit values may be in the filter."""
    size = len(bits).bit_length() - 1 + 5
    mask = np.uint64((1 << size) - 1)
    low = values & mask
    high = (values >> np.uint64(32)) & mask

    def has(at: np.ndarray) -> np.ndarray:
        return (bits[(at >> np.uint64(5)).astype(np.int64)] >> (at & np.uint64(31)).astype(np.uint32)) & np.uint32(1) != 0

    found = has(low)
    at = np.flatnonzero(found)
    found[at] = has(high[at])
    return found
