"""Removal of repeated byte strings by suffix arrays of shards.

A byte goes if it lies in a string of ``length`` bytes that also starts earlier in the
corpus (a smaller document id, or earlier in the same document).

* Each window of ``length`` bytes has a minimizer, the least hash of its grams of
  ``GRAM`` bytes.  Equal windows have equal minimizers, so a minimizer that stands at one
  place only has no repeats.  The minimizers of all documents are sorted by Spark, and
  those that stand at several places are kept.
* The runs of windows under such a minimizer, as pieces of text, go to the shard of that
  minimizer: all equal windows meet in one shard.  Equal pieces are collapsed: all but
  the earliest are covered whole.  A minimizer left with one piece that holds it once has
  no two windows to compare and needs no sorting.
* A shard's distinct pieces become one text, its suffix array is made by induced sorting
  and its common prefixes by the permuted recurrence (:mod:`suffix_array`).  Suffixes
  that share ``length`` bytes stand side by side; all but the earliest are covered.
* The covered stretches meet their document again, which is cut.

A shard's text is bounded: groups of one minimizer are packed up to ``SHARD_BYTES``, and
a single group beyond ``GROUP_BYTES`` is not kept together but leaves the task as pieces
whose windows Spark groups as strings.  Copies of a text that a task has already seen
from an earlier document are covered at once.

Defined cases: a null text is empty; texts shorter than ``length`` bytes stay; equal rows
(same id and text) are one document, judged once; of rows with one id and several texts
the one with the smaller checksum is earlier (CRC-32, then 31 bits of another hash: 63 bits
tell the texts apart); a null id comes last; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words
from .common import map_batches, materialize
from .suffix_array import permuted_lcp, suffix_array

LENGTH = 100
GRAM = 40
SHARD_BYTES = 1 << 20
GROUP_BYTES = 2 << 20
SALTS = 32  # parts of the places of one window string
LAST = (1 << 63) - 1  # the place of a null id


def _grams(data: np.ndarray, size: int) -> np.ndarray:
    """The hash of the ``size`` bytes from each byte on."""
    up, down = words._POWERS.get(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(words.BYTE_VALUE[data] * up[: len(data)], out=total[1:])
    out = np.full(len(data), ~np.uint64(0))
    n = len(data) - size + 1
    if n > 0:
        value = (total[size:] - total[:n]) * down[:n]
        out[:n] = words.mix(value)
    return out


def minimizers(data: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The gram hashes, the least of each window, and which windows are whole; ``ends``
    has for each byte the end of its text."""
    grams = _grams(data, min(GRAM, length))
    least = words.sliding_min(grams, length - min(GRAM, length) + 1)
    return grams, least, np.arange(len(data)) + length <= ends


def _places(length: int):
    """value, ord, crc, times: the distinct minimizers of each text, and whether they stand
    there once or more (2).  A text that the task has seen from an earlier document is
    one row with times = -1 - its bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, tuple[int, int]] = {}
        for batch in batches:
            ords, crcs = batch.column("ord").to_numpy(), batch.column("crc").to_numpy()
            for row, end, data, offsets in words.chunks(batch.column("text")):
                skip = np.zeros(end - row, bool)
                for i in range(end - row):
                    if offsets[i + 1] - offsets[i] < length:
                        skip[i] = True
                        continue
                    digest = hashlib.blake2b(data[offsets[i] : offsets[i + 1]], digest_size=16).digest()
                    key = (int(ords[row + i]), int(crcs[row + i]))
                    if key == seen.setdefault(digest, key):
                        continue
                    if key < seen[digest]:
                        seen[digest] = key
                    else:
                        skip[i] = True
                sizes = np.diff(offsets)
                copied = np.flatnonzero(skip & (sizes >= length))
                at = np.arange(row, end)
                if len(copied):
                    yield pa.RecordBatch.from_arrays(
                        [words.signed(words.mix(copied.astype(np.uint64))), pa.array(ords[row + copied]), pa.array(crcs[row + copied]), pa.array(-1 - sizes[copied])], names=["value", "ord", "crc", "times"]
                    )
                if skip.all():
                    continue
                grams, least, whole = minimizers(data, np.repeat(offsets[1:], sizes), length)
                whole &= ~np.repeat(skip, sizes)
                kept = words.sliding_max_back(np.where(whole, least, np.uint64(0)), length - min(GRAM, length) + 1)
                place = np.flatnonzero((kept == grams) & (grams != 0))
                owner = np.searchsorted(offsets, place, "right") - 1
                found = grams[place]
                order = np.lexsort((found, owner))
                found, owner = found[order], owner[order]
                opens = np.ones(len(found), bool)
                opens[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
                first = np.flatnonzero(opens)
                times = np.minimum(np.diff(np.append(first, len(found))), 2)
                found, owner = found[first], owner[first]
                yield pa.RecordBatch.from_arrays(
                    [words.signed(found), pa.array(ords[at[owner]]), pa.array(crcs[at[owner]]), pa.array(times)], names=["value", "ord", "crc", "times"]
                )

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by value: those whose value stands at several places, and the
    whole copies."""
    held, shared = None, False

    def give(batch: pa.RecordBatch, keep: np.ndarray) -> pa.RecordBatch:
        return batch.filter(pa.array(keep | (batch.column("times").to_numpy() != 1)))

    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.concat_batches([held, batch])
        values = batch.column("value").to_numpy()
        same = np.zeros(len(values) + 1, bool)
        same[1:-1] = values[1:] == values[:-1]
        same[0] = shared
        yield give(batch.slice(0, len(values) - 1), (same[:-1] | same[1:])[:-1])
        held, shared = batch.slice(len(values) - 1), bool(same[-2])
    if held is not None:
        yield give(held, np.array([shared]))


def _pieces(length: int):
    """value, ord, crc, start, again, piece: the runs of windows under the document's
    shared minimizers, each as the text that these windows cover, and whether it holds
    the minimizer more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ords, crcs = batch.column("ord"), batch.column("crc")
            for row, end, data, offsets in words.chunks(batch.column("text")):
                sizes = np.diff(offsets)
                grams, least, whole = minimizers(data, np.repeat(offsets[1:], sizes), length)
                at = np.flatnonzero(whole)
                if not len(at):
                    continue
                value = least[at]
                owner = np.searchsorted(offsets, at, "right") - 1
                opens = np.ones(len(at), bool)
                opens[1:] = (value[1:] != value[:-1]) | (at[1:] != at[:-1] + 1) | (owner[1:] != owner[:-1])
                first = np.flatnonzero(opens)
                last = np.append(first[1:], len(at)) - 1
                value, owner, begin, stop = value[first], owner[first], at[first], at[last] + length
                wanted = np.zeros(len(first), bool)
                for i in range(end - row):
                    mine = np.searchsorted(owner, [i, i + 1])
                    shared = batch.column("values")[row + i].values.to_numpy().view(np.uint64)
                    wanted[mine[0] : mine[1]] = np.isin(value[mine[0] : mine[1]], shared)
                value, owner, begin, stop = value[wanted], owner[wanted], begin[wanted], stop[wanted]
                # Places of a run's own value: where the gram is the least of a window of it.
                width = length - min(GRAM, length)
                again = np.array([np.count_nonzero(grams[a : b - length + 1 + width] == v) > 1 for a, b, v in zip(begin.tolist(), stop.tolist(), value, strict=True)], bool)
                raw = data.tobytes()
                picked = pa.array(row + owner)
                yield pa.RecordBatch.from_arrays(
                    [words.signed(value), ords.take(picked), crcs.take(picked), pa.array(begin - offsets[owner]), pa.array(again), pa.array([raw[a:b] for a, b in zip(begin.tolist(), stop.tolist(), strict=True)], pa.binary())],
                    names=["value", "ord", "crc", "start", "again", "piece"],
                )

    return run


COVERED = "ord long, crc long, low long, high long, piece binary"


def covered_windows(pieces: list[bytes], ords: np.ndarray, crcs: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of distinct pieces with their earliest places: runs of windows that start earlier
    elsewhere, as (piece, first byte, end byte) of each run."""
    sizes = np.array([len(p) for p in pieces])
    text = np.zeros(sizes.sum() + len(pieces) + 1, np.uint16)
    begin = np.cumsum(sizes + 1) - sizes - 1
    text[:-1] = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8)
    text[:-1] += 2
    text[begin + sizes] = 1  # between pieces
    order = suffix_array(text)
    alike = permuted_lcp(text, order)[order] >= length
    owner = np.searchsorted(begin, order, "right") - 1
    offset = order - begin[owner]
    group = np.cumsum(~alike)
    several = alike.copy()
    several[:-1] |= alike[1:]
    at = np.flatnonzero(several & (offset + length <= sizes[owner]))
    owner, offset, group = owner[at], offset[at], group[at]
    rank = np.lexsort((starts[owner] + offset, crcs[owner], ords[owner], group))
    later = np.ones(len(rank), bool)
    later[:1] = False
    later[1:] = group[rank][1:] == group[rank][:-1]
    owner, offset = owner[rank][later], offset[rank][later]
    rank = np.lexsort((offset, owner))
    owner, offset = owner[rank], offset[rank]
    if not len(owner):
        return owner, offset, offset
    opens = np.ones(len(owner), bool)
    opens[1:] = (owner[1:] != owner[:-1]) | (offset[1:] > offset[:-1] + length)
    first = np.flatnonzero(opens)
    last = np.append(first[1:], len(owner)) - 1
    return owner[first], offset[first], offset[last] + length


def _shards(length: int, shard_bytes: int, group_bytes: int):
    """From pieces sorted by value, text and place: covered stretches, and the pieces of
    groups too large to keep."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard: list[tuple[bytes, int, int, int]] = []  # distinct pieces of whole groups
        group: list[tuple[bytes, int, int, int]] = []  # of the group being read
        shard_size = group_size = 0
        value, large, several = None, False, False
        out: list[tuple[int, int, int, int, bytes | None]] = []

        def close_shard():
            nonlocal shard, shard_size
            if shard:
                pieces, ords, crcs, starts = zip(*shard, strict=True)
                for i, a, b in zip(*(x.tolist() for x in covered_windows(list(pieces), np.array(ords), np.array(crcs), np.array(starts), length)), strict=True):
                    out.append((ords[i], crcs[i], starts[i] + a, starts[i] + b, None))
            shard, shard_size = [], 0

        def close_group():
            nonlocal group, group_size, shard_size
            if len(group) > 1 or several:
                if shard_size + group_size > shard_bytes:
                    close_shard()
                shard.extend(group)
                shard_size += group_size
            group, group_size = [], 0

        def flush():
            cols = zip(*out, strict=True) if out else [[]] * 5
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            done = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["ord", "crc", "low", "high", "piece"])
            out.clear()
            return done

        last, place = None, None
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("value", "ord", "crc", "start", "again", "piece")), strict=True)
            for v, o, c, start, again, piece in rows:
                if v != value:
                    close_group()
                    value, large, several, last = v, False, False, None
                several |= again
                if piece == last:
                    if (o, c, start) != place:  # else an equal row: the same document
                        out.append((o, c, start, start + len(piece), None))
                    continue
                last, place = piece, (o, c, start)
                if not large:
                    group.append((piece, o, c, start))
                    group_size += len(piece)
                    if group_size > group_bytes:
                        large = True
                        out.extend((o2, c2, s2, s2, p2) for p2, o2, c2, s2 in group)
                        group, group_size = [], 0
                else:
                    out.append((o, c, start, start, piece))
            if len(out) >= 1 << 14:
                yield flush()
        close_group()
        close_shard()
        yield flush()

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cuts the covered stretches out of each text."""
    for batch in batches:
        out = []
        for raw, low, high in zip(batch.column("text"), batch.column("low"), batch.column("high"), strict=True):
            data = raw.as_py().encode("utf-8", "surrogatepass") if isinstance(raw.as_py(), str) else raw.as_py()
            kept, at, removed, spans = [], 0, 0, 0
            if low.is_valid and len(low.values):
                a, b = low.values.to_numpy(), high.values.to_numpy()
                order = np.argsort(a, kind="stable")
                a, b = a[order], np.maximum.accumulate(b[order])
                opens = np.ones(len(a), bool)
                opens[1:] = a[1:] > b[:-1]
                first = np.flatnonzero(opens)
                for x, y in zip(a[first].tolist(), b[np.append(first[1:], len(a)) - 1].tolist(), strict=True):
                    kept.append(data[at:x])
                    removed += y - x
                    spans += 1
                    at = y
            kept.append(data[at:])
            rest = b"".join(kept)
            out.append((len(data), removed, spans, hashlib.sha256(rest).hexdigest(), rest))
        cols = zip(*out, strict=True) if out else [[]] * 5
        types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
        arrays = [pa.array(c, t) for c, t in zip(cols, types, strict=True)]
        keep = [n for n in batch.schema.names if n not in ("text", "low", "high", "kept")]
        if "kept" in batch.schema.names:
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in keep), *arrays], names=[*keep, *names])
        else:
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in keep), *arrays[:4]], names=[*keep, *names[:4]])


FILTER_BITS = 1 << 23


def _slot():
    """The bit of a document in a filter of a fixed number of bits."""
    return F.pmod(F.xxhash64("ord", "crc"), F.lit(FILTER_BITS))


def _filter_words(keys: DataFrame) -> DataFrame:
    """The filter of the documents (ord, crc) as words of 32 bits: at most
    ``FILTER_BITS / 32`` rows, which is the bound of its broadcast."""
    slot = keys.select(_slot().alias("slot"))
    words_ = slot.select(F.expr("cast(slot div 32 as int)").alias("word"), F.expr("shiftleft(1L, cast(slot % 32 as int))").alias("bit"))
    return materialize(words_.groupBy("word").agg(F.bit_or("bit").alias("bits")), "filter")


def _split(rows: DataFrame, filter_words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows that may be among the filter's documents, and those that are not.  Only
    the former are dealt out; a full filter lets all through."""
    flagged = rows.withColumn("word", F.expr(f"cast(({FILTER_BITS - 1} & xxhash64(ord, crc)) div 32 as int)")).join(F.broadcast(filter_words), "word", "left")
    may = F.expr("coalesce(getbit(bits, cast(pmod(xxhash64(ord, crc), 32) as int)), 0) = 1")
    return flagged.where(may).drop("word", "bits"), flagged.where(~may).drop("word", "bits")


def _checksum(text: Column) -> Column:
    """CRC-32 of the text, and below it the low 31 bits of its 64-bit hash."""
    return F.shiftleft(F.crc32(text.cast("binary")), 31).bitwiseOR(F.xxhash64(text).bitwiseAND(F.lit((1 << 31) - 1)))


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES, group_bytes: int = GROUP_BYTES, with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of each row; with ``with_text``
    also kept, the bytes that stay."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("ord"), _checksum(text).alias("crc"), text.alias("text"))
    texts = rows.select("ord", "crc", "text")

    places = map_batches(texts, _places(length), "value long, ord long, crc long, times long").repartition("value").sortWithinPartitions("value")
    shared = materialize(map_batches(places, _shared, "value long, ord long, crc long, times long"), "shared-places")
    copies = shared.where("times < 0").select("ord", "crc", F.lit(0).cast("long").alias("low"), (-1 - F.col("times")).alias("high"), F.lit(None).cast("binary").alias("piece"))
    values = shared.where("times > 0").groupBy("ord", "crc").agg(F.collect_set("value").alias("values"))

    concerned, _ = _split(texts, _filter_words(values))
    distinct = map_batches(concerned.join(values, ["ord", "crc"]), _pieces(length), "value long, ord long, crc long, start long, again boolean, piece binary")
    dealt = distinct.repartition("value").sortWithinPartitions("value", "piece", "ord", "crc", "start")
    found = materialize(map_batches(dealt, _shards(length, shard_bytes, group_bytes), COVERED), "covered")

    # Groups beyond the bound: their windows as strings.
    window = (
        found.where("piece is not null")
        .select("ord", "crc", "low", "piece", F.explode(F.expr(f"sequence(0, length(piece) - {length})")).alias("i"))
        .select(F.expr(f"substring(piece, i + 1, {length})").alias("window"), F.struct("ord", "crc", (F.col("low") + F.col("i")).alias("low")).alias("place"))
    )
    # A window that stands at very many places is dealt in parts: the least place of each
    # part, then of the window, which goes back to the parts.
    salted = window.withColumn("salt", F.pmod(F.xxhash64("place"), F.lit(SALTS)))
    least = salted.groupBy("window", "salt").agg(F.min("place").alias("least"))
    first = least.groupBy("window").agg(F.min("least").alias("first"))
    parts = least.join(first, "window").select("window", "salt", "first")
    strings = salted.join(parts, ["window", "salt"]).where("place != first").select("place.ord", "place.crc", "place.low", (F.col("place.low") + length).alias("high"))

    covered = found.where("piece is null").drop("piece").union(copies.drop("piece")).union(strings)
    stretches = covered.distinct().groupBy("ord", "crc").agg(F.collect_list(F.struct("low", "high")).alias("all")).select("ord", "crc", F.col("all.low").alias("low"), F.col("all.high").alias("high"))
    stretches = materialize(stretches, "stretches")
    cut, whole = _split(rows, _filter_words(stretches))
    held = cut.join(stretches, ["ord", "crc"], "left").select("doc_id", "text", "low", "high", *([F.lit(True).alias("kept")] if with_text else []))
    fields = [rows.schema["doc_id"], T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()), T.StructField("kept_sha256", T.StringType())]
    if with_text:
        fields.append(T.StructField("kept", T.BinaryType()))
    raw = F.col("text").cast("binary")
    zero = F.lit(0).cast("long")
    untouched = whole.select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"), F.sha2(raw, 256).alias("kept_sha256"), *([raw.alias("kept")] if with_text else [])
    )
    return map_batches(held, _cut, T.StructType(fields)).union(untouched)
