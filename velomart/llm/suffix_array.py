"""Suffix arrays by induced sorting, and permuted common prefixes.

The construction classifies suffixes as smaller (S) or larger (L) than their right
neighbour, sorts the leftmost smaller (LMS) substrings by inducing from them in text
order, names them, sorts the reduced text recursively if names repeat, and induces the
whole order from the sorted LMS suffixes.  A pass over an alphabet of bytes handles a
whole bucket's entries at once; the reduced texts have large alphabets of few entries
each and are scanned one by one.
"""

from __future__ import annotations

import numpy as np

from .words import mix

SMALL_ALPHABET = 1024


def classify(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one after it; the last, unique least
    symbol counts as smaller."""
    n = len(text)
    out = np.ones(n, bool)
    if n > 1:
        differ = text[:-1] != text[1:]
        at = np.where(differ, np.arange(n - 1), n - 1)
        following = np.minimum.accumulate(at[::-1])[::-1]
        out[:-1] = (text[:-1] < text[1:])[np.minimum(following, n - 2)]
    return out


def _grouped(text: np.ndarray, at: np.ndarray, into: list[list[np.ndarray]]) -> None:
    """Appends the positions to the lists of their symbols, in order."""
    if not len(at):
        return
    symbol = text[at]
    order = np.argsort(symbol, kind="stable")
    at, symbol = at[order], symbol[order]
    cuts = [0, *(np.flatnonzero(symbol[1:] != symbol[:-1]) + 1).tolist(), len(at)]
    for a, b, c in zip(cuts[:-1], cuts[1:], symbol[cuts[:-1]].tolist(), strict=True):
        into[c].append(at[a:b])


def _induce_buckets(text: np.ndarray, smaller: np.ndarray, lms: np.ndarray, symbols: int) -> np.ndarray:
    seeds: list[list[np.ndarray]] = [[] for _ in range(symbols)]
    _grouped(text, lms, seeds)

    def drain(bucket: list[np.ndarray], into: list[list[np.ndarray]], want: bool) -> np.ndarray:
        """Takes a bucket's entries, also those that it gains on the way; what stands
        before each entry, if of the wanted kind, joins its own bucket."""
        taken = 0
        while taken < len(bucket):
            now = bucket[taken] if taken == len(bucket) - 1 else np.concatenate(bucket[taken:])
            taken = len(bucket)
            before = now[now > 0] - 1
            _grouped(text, before[smaller[before] == want], into)
        return np.concatenate(bucket) if bucket else np.zeros(0, np.int64)

    larger: list[list[np.ndarray]] = [[] for _ in range(symbols)]
    left = []
    for c in range(symbols):
        left.append(drain(larger[c], larger, False))
        for piece in seeds[c]:
            before = piece[piece > 0] - 1
            _grouped(text, before[~smaller[before]], larger)
    right: list[list[np.ndarray]] = [[] for _ in range(symbols)]
    right[int(text[-1])].append(np.array([len(text) - 1]))
    done = [np.zeros(0, np.int64)] * symbols
    for c in range(symbols - 1, -1, -1):
        done[c] = drain(right[c], right, True)
        before = left[c][::-1]
        before = before[before > 0] - 1
        _grouped(text, before[smaller[before]], right)
    return np.concatenate([part for c in range(symbols) for part in (left[c], done[c][::-1])])


def _induce_one_by_one(text: np.ndarray, smaller: np.ndarray, lms: np.ndarray, symbols: int) -> np.ndarray:
    sizes = np.bincount(text, minlength=symbols)
    ends = np.cumsum(sizes)
    t, s = text.tolist(), smaller.tolist()
    order = [-1] * len(t)
    tail = ends.tolist()
    for p in reversed(lms.tolist()):
        c = t[p]
        tail[c] -= 1
        order[tail[c]] = p
    head = (ends - sizes).tolist()
    for p in order:  # grows ahead of the scan
        if p > 0 and not s[p - 1]:
            c = t[p - 1]
            order[head[c]] = p - 1
            head[c] += 1
    tail = ends.tolist()
    for i in range(len(t) - 1, -1, -1):
        p = order[i]
        if p > 0 and s[p - 1]:
            c = t[p - 1]
            tail[c] -= 1
            order[tail[c]] = p - 1
    return np.array(order, np.int64)


def _names(text: np.ndarray, lms: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """For each LMS position, in text order, the rank of its substring among the
    distinct ones."""
    n = len(text)
    base = np.full(n + 1, 0x9E3779B97F4A7C15 | 1, np.uint64)
    base[0] = 1
    up = np.multiply.accumulate(base)
    base[1:] = pow(0x9E3779B97F4A7C15 | 1, -1, 1 << 64)
    down = np.multiply.accumulate(base)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(mix(text.astype(np.uint64)) * up[:n], out=total[1:])
    end = np.append(lms[1:], n - 1) + 1
    digest = (total[end] - total[lms]) * down[lms]
    size = end - lms
    rank_of = np.zeros(n, np.int64)
    rank_of[lms] = np.arange(len(lms))
    at = rank_of[ordered]
    fresh = (digest[at[1:]] != digest[at[:-1]]) | (size[at[1:]] != size[at[:-1]])
    names = np.zeros(len(lms), np.int64)
    names[at[1:]] = np.cumsum(fresh)
    return names


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Positions of the suffixes in order.  ``text``: small whole numbers from 0 that end
    in a 0 found nowhere else."""
    n = len(text)
    if n == 1:
        return np.zeros(1, np.int64)
    symbols = int(text.max()) + 1
    induce = _induce_buckets if symbols <= SMALL_ALPHABET else _induce_one_by_one
    smaller = classify(text)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    order = induce(text, smaller, lms, symbols)
    if len(lms) > 1:
        is_lms = np.zeros(n, bool)
        is_lms[lms] = True
        ordered = order[is_lms[order]]
        names = _names(text, lms, ordered)
        if names.max() + 1 < len(lms):
            ordered = lms[suffix_array(names)]
        order = induce(text, smaller, ordered, symbols)
    return order


def permuted_lcp(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each position, the length of the common prefix of its suffix and the one
    before it in order (0 for the first).

    Where the symbols before the two suffixes agree, the length is that of the position
    before less one; only the others are compared.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    place = np.arange(n)
    own = np.ones(n, bool)
    follows = (place > 0) & (before > 0)
    at = np.flatnonzero(follows)
    own[at] = text[at - 1] != text[before[at] - 1]
    # A position can only follow one that has a suffix before it.
    at = np.flatnonzero(~own)
    own[at[before[at - 1] < 0]] = True
    wide = np.zeros(n + 4, np.uint64)
    wide[:n] = text
    packed = wide[:-3] | wide[1:-2] << np.uint64(16) | wide[2:-1] << np.uint64(32) | wide[3:] << np.uint64(48)
    length = np.zeros(n, np.int64)
    i = np.flatnonzero(own & (before >= 0))
    j, size = before[i], np.zeros(len(i), np.int64)
    live = np.arange(len(i))
    while len(live):
        a, b = i[live] + size[live], j[live] + size[live]
        same = packed[np.minimum(a, n)] == packed[np.minimum(b, n)]
        size[live[same]] += 4
        live = live[same & (np.maximum(a, b) < n)]
    for _ in range(3):
        a, b = i + size, j + size
        size += (a < n) & (b < n) & (text[np.minimum(a, n - 1)] == text[np.minimum(b, n - 1)])
    length[i] = size
    # The others count down from the last compared position before them.
    origin = np.maximum.accumulate(np.where(own, place, 0))
    return np.where(own, length, np.maximum(0, length[origin] - (place - origin)))
