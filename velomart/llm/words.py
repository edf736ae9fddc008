"""Words of many texts at once, on the bytes of an Arrow string column.

A batch's texts lie behind each other in one buffer; a table of 256 booleans
says which bytes belong to words, so words, their hashes and the hashes of
n-grams are found with array operations, without a Python string per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)
_BASE = 0x2545F4914F6CDD1D | 1
_MASK = (1 << 64) - 1

# Bytes of words.  A UTF-8 byte of 0x80 or more is part of a letter beyond ASCII,
# so both classes of characters are classes of bytes as well.
LETTERS_AND_DIGITS = np.zeros(256, bool)  # [^\x00-\x2F\x3A-\x60\x7B-\x7F] after lower-casing A-Z
LETTERS_AND_DIGITS[0x30:0x3A] = LETTERS_AND_DIGITS[0x61:0x7B] = LETTERS_AND_DIGITS[0x80:] = True
NOT_SPACE = np.ones(256, bool)  # [^\x20\x09-\x0D]
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = x + _GOLDEN
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64))


class _Powers:
    """Powers of the base and of its inverse, grown as longer chunks come."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), CHUNK_BYTES)
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up, self.down


_POWERS = _Powers()


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of at most ``limit`` bytes (or one longer text): first row, end
    row, their bytes, and the offset of each text in them plus the end.  Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        end = min(end, n)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def spans(data: np.ndarray, offsets: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and for each text the number of the first word
    (one more number than texts)."""
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = member[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside[:-1]
    cuts = offsets[1:-1]
    before[cuts] = False
    starts = np.flatnonzero(inside & ~before)
    after = inside[1:].copy()
    after[cuts[cuts > 0] - 1] = False
    ends = np.flatnonzero(inside[:-1] & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes."""
    up, down = _POWERS.get(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUE[data] * up[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """The hash of the ``n`` words from each word on (fewer at the end: wrapped
    values that callers leave out)."""
    total = np.zeros(len(words), np.uint64)
    base = np.uint64(_BASE)
    for k in range(n):
        total = total * base
        total[: max(0, len(words) - k)] += words[k:]
    return mix(total)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of ``width`` values from each position on; the array ends shorten it."""
    out, have = values.copy(), 1
    while have < width:
        step = min(have, width - have)
        kept = max(0, len(out) - step)
        np.minimum(out[:kept], out[step:], out=out[:kept])
        have += step
    return out


def sliding_max_back(values: np.ndarray, width: int) -> np.ndarray:
    """The largest of the ``width`` values that end at each position."""
    out, have = values.copy(), 1
    while have < width:
        step = min(have, width - have)
        out[step:] = np.maximum(out[step:], out[: max(0, len(out) - step)])
        have += step
    return out


def signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64), pa.int64())
