"""Ranked lexical search over buckets of impact vectors of like length.

A document is the vector of its terms' impacts, an item the vector of its terms' counts,
both with the square root of a term's weight as a factor, so that their product is the
score.  Vectors are ordered by length and cut into buckets.  An item's current tenth score
bounds what it still needs:

* a bucket whose longest vector times the item's length stays below it is passed over
  (Cauchy-Schwarz); the shortest length that any item still needs is a filter on the
  stored, ordered table, so Parquet skips the rest of it;
* in a bucket, bounds on the item's heaviest coordinates (the range that a unit vector's
  coordinate must lie in to reach the angle needed), then their exact share of the product
  plus Cauchy-Schwarz for the rest, leave the survivors;
* survivors are scored again exactly, in 64-bit integers.

The bucket of the longest vectors is searched first and gives every item a first bound,
which is broadcast; each task sharpens it for itself and reports at most ``k`` documents an
item.  All bounds are taken a little too wide, so no rounding loses a document.

Items are the queries, in blocks of about ``BLOCK_TERMS`` distinct terms, so what is
broadcast (a block's terms, weights and bounds) has a fixed size however many items there
are; each block reads the documents once.  Terms are told apart by 64-bit hashes.  Counts
(documents, terms, document frequencies) are sums over all documents.

Defined cases: null texts and texts without a term are no documents of the count and have
no rows, whether document or item; equal rows are ranked each on its own; a null doc_id
comes after all others of its score, a null item_id is an item; empty tables give no rows;
other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from . import words
from .common import map_batches, materialize

BLOCK_TERMS = 1 << 18
BUCKET_LOG2 = 12  # rows of a bucket
FOCUS = 4  # coordinates of an item that are bounded
SLACK = 1 + 1e-9


def _terms(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, the hash of each term of a run of texts, and the number of the first
    term of each text (one more number than texts)."""
    for row, _, data, offsets in words.chunks(column):
        text = words.LOWER[data]
        starts, ends, first = words.spans(text, offsets, words.LETTERS_AND_DIGITS)
        yield row, words.span_hashes(text, starts, ends).view(np.int64), first


def _lists(offsets: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def _item_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """item (a number), item_id, and the distinct terms with their counts."""
    number = TaskContext.get().partitionId() << 40
    for batch in batches:
        at, terms, counts = [], [], []
        for row, hashes, first in _terms(batch.column("text")):
            for i in np.flatnonzero(np.diff(first)):
                found, times = np.unique(hashes[first[i] : first[i + 1]], return_counts=True)
                at.append(row + i)
                terms.append(found)
                counts.append(times)
        ends = np.cumsum([0, *map(len, terms)])
        none = np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(number + np.array(at, np.int64)),
                batch.column("item_id").take(pa.array(at, pa.int64())),
                _lists(ends, np.concatenate([none, *terms]), pa.int64()),
                _lists(ends, np.concatenate([none, *counts]), pa.int64()),
            ],
            names=["item", "item_id", "terms", "times"],
        )
        number += batch.num_rows


def _document_vectors(sent):
    """doc_id, n, a running number, and the places in the vocabulary and frequencies of a
    document's terms; documents with no term at all are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = sent.value
        number = 0
        for batch in batches:
            for row, hashes, first in _terms(batch.column("text")):
                n = np.diff(first)
                at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
                known = np.flatnonzero(vocabulary[at] == hashes)
                of = np.searchsorted(first, known, "right") - 1
                pairs, times = np.unique(of * len(vocabulary) + at[known], return_counts=True)
                rows = np.flatnonzero(n)
                bounds = np.searchsorted(pairs, np.append(rows, len(n)) * len(vocabulary))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array(row + rows)),
                        pa.array(n[rows], pa.int64()),
                        pa.array(number + row + rows),
                        _lists(bounds, pairs % len(vocabulary), pa.int32()),
                        _lists(bounds, times, pa.int32()),
                    ],
                    names=["doc_id", "n", "tie", "terms", "times"],
                )
            number += batch.num_rows

    return run


def _impacts(sent, documents: int, length: int):
    """The terms' impacts and the length of the vector; vectors of length 0 are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = sent.value
        for batch in batches:
            lists, times = batch.column("terms"), batch.column("times")
            terms, tf = lists.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
            sizes = pc.list_value_length(lists).to_numpy().astype(np.int64)
            m = 25 + 75 * batch.column("n").to_numpy() * documents // length
            impact = 1_000_000_000 * tf // (1000 * tf + 8 * np.repeat(m, sizes))
            ends = np.cumsum(np.append(0, sizes))
            rows = np.repeat(np.arange(len(sizes)), sizes)
            norm = np.sqrt(np.bincount(rows, weights[terms] * impact.astype(np.float64) ** 2, len(sizes)))
            keep = pa.array(np.flatnonzero(norm))
            whole = pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("tie"), lists, _lists(ends, impact, pa.int32()), pa.array(norm)], names=["doc_id", "tie", "terms", "impacts", "norm"]
            )
            yield whole.take(keep)

    return run


@dataclass
class Item:
    """An item against a block's vocabulary, heaviest coordinate first."""

    item: int
    terms: np.ndarray  # places in the vocabulary
    weights: np.ndarray  # count times weight, integers
    vector: np.ndarray  # count times the weight's root
    norm: float
    least: int  # the k-th best score known so far, 0 if there are fewer


def coordinate_range(q: float, cosine: float) -> tuple[float, float]:
    """What a unit vector's coordinate must lie in to reach ``cosine`` with a unit vector
    whose coordinate is ``q``."""
    side = math.sqrt(max(0.0, 1 - q * q) * max(0.0, 1 - cosine * cosine))
    return q * cosine - side - 1e-9, (q * cosine + side if q < cosine else 1.0) + 1e-9


class Bucket:
    """Vectors of like length, as postings by term."""

    def __init__(self, terms: np.ndarray, impacts: np.ndarray, sizes: np.ndarray, norms: np.ndarray, root: np.ndarray) -> None:
        order = np.argsort(terms, kind="stable")
        self.rows = np.repeat(np.arange(len(sizes)), sizes)[order]
        self.impacts = impacts[order].astype(np.int64)
        self.ends = np.searchsorted(terms[order], np.arange(len(root) + 1))
        self.norms, self.root = norms, root
        self.longest = float(norms.max())

    def posting(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.ends[term], self.ends[term + 1]
        return self.rows[a:b], self.impacts[a:b]

    def survivors(self, item: Item) -> np.ndarray | None:
        """Rows that may reach the item's least score; None: no bound holds yet."""
        if not item.least:
            return None
        cosine = min(1.0, item.least / (item.norm * self.longest * SLACK))
        alive = np.ones(len(self.norms), bool)
        share, squares, left = np.zeros(len(self.norms)), np.zeros(len(self.norms)), item.norm**2
        for term, q in zip(item.terms[:FOCUS].tolist(), item.vector[:FOCUS].tolist(), strict=True):
            rows, impacts = self.posting(term)
            p = impacts * self.root[term]
            low, high = coordinate_range(q / item.norm, cosine)
            unit = p / self.norms[rows]
            alive[rows[unit > high]] = False
            if low > 0:
                has = np.zeros(len(alive), bool)
                has[rows[unit >= low]] = True
                alive &= has
            share[rows] += q * p
            squares[rows] += p * p
            left -= q * q
        rest = np.sqrt((self.norms**2 - squares).clip(0) * max(0.0, left) * SLACK + 1e-9 * item.norm**2 * self.norms**2)
        return np.flatnonzero(alive & ((share + rest) * SLACK >= item.least))

    def scores(self, item: Item) -> np.ndarray:
        out = np.zeros(len(self.norms), np.int64)
        for term, weight in zip(item.terms.tolist(), item.weights.tolist(), strict=True):
            rows, impacts = self.posting(term)
            out[rows] += weight * impacts
        return out


def _best(scores: np.ndarray, ids: pa.Array, k: int) -> np.ndarray:
    """The rows of the k highest scores, equal ones by id."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= least)
        table = pa.table({"score": scores[near], "id": ids.take(pa.array(near))})
        order = pc.sort_indices(table, sort_keys=[("score", "descending"), ("id", "ascending")], null_placement="at_end")
        return near[order.to_numpy()[:k]]
    return np.arange(len(scores))


def _search(sent, k: int):
    """item, score, doc_id: of each item at most the k best documents of the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, root = sent.value
        least = [item.least for item in items]
        found: list[list[tuple]] = [[] for _ in items]
        kind = None
        for batch in batches:
            kind = batch.column("doc_id").type
            if not batch.num_rows:
                continue
            marks = batch.column("bucket").to_numpy()
            cuts = np.append(np.flatnonzero(np.append(True, marks[1:] != marks[:-1])), len(marks)).tolist()
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                part = batch.slice(a, b - a)
                lists = part.column("terms")
                bucket = Bucket(
                    lists.flatten().to_numpy(), part.column("impacts").flatten().to_numpy(), pc.list_value_length(lists).to_numpy(), part.column("norm").to_numpy(), root
                )
                ids = part.column("doc_id")
                for i, item in enumerate(items):
                    now = Item(item.item, item.terms, item.weights, item.vector, item.norm, least[i])
                    if now.least > now.norm * bucket.longest * SLACK:
                        continue
                    rows = bucket.survivors(now)
                    if rows is not None and not len(rows):
                        continue
                    scores = bucket.scores(now)
                    rows = np.flatnonzero(scores >= max(1, now.least)) if rows is None else rows[scores[rows] >= max(1, now.least)]
                    if not len(rows):
                        continue
                    mine = ids.take(pa.array(rows))
                    top = _best(scores[rows], mine, k)
                    found[i] += [(-s, d is None, d) for s, d in zip(scores[rows[top]].tolist(), mine.take(pa.array(top)).to_pylist(), strict=True)]
                    found[i].sort()
                    del found[i][k:]
                    if len(found[i]) == k:
                        least[i] = max(least[i], -found[i][-1][0])
        if kind is not None:
            out = [(item.item, -s, d) for item, rows in zip(items, found, strict=True) for s, _, d in rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int64()), pa.array([r[2] for r in out], kind)], names=["item", "score", "doc_id"]
            )

    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    row = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(row)).where(F.col("rank") <= k)


def _search_block(docs: DataFrame, items: list[dict], k: int) -> DataFrame | None:
    spark = docs.sparkSession
    vocabulary = np.unique(np.concatenate([r["terms"] for r in items]).astype(np.int64))
    sent = spark.sparkContext.broadcast(vocabulary)
    id_type = docs.schema["doc_id"].dataType
    field = lambda name, kind: T.StructField(name, kind, True)
    ints = T.ArrayType(T.IntegerType())
    schema = T.StructType([field("doc_id", id_type), field("n", T.LongType()), field("tie", T.LongType()), field("terms", ints), field("times", ints)])
    vectors = materialize(map_batches(docs, _document_vectors(sent), schema), "term-counts")
    documents, length = vectors.agg(F.count("*"), F.sum("n")).first()
    if not documents:
        return None
    counts = vectors.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow()
    df = dict(zip(counts["term"].to_pylist(), counts["count"].to_pylist(), strict=True))
    weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1))) if t in df else 0 for t in range(len(vocabulary))], np.int64)
    root = np.sqrt(weights.astype(np.float64))
    block = []
    for r in items:
        at = np.searchsorted(vocabulary, r["terms"])
        keep = weights[at] > 0
        at, times = at[keep], np.array(r["times"], np.int64)[keep]
        order = np.argsort(-times * root[at], kind="stable")
        at, times = at[order], times[order]
        if len(at):
            vector = times * root[at]
            block.append(Item(r["item"], at, times * weights[at], vector, float(np.sqrt((vector**2).sum())), 0))
    if not block:
        return None
    schema = T.StructType([field("doc_id", id_type), field("tie", T.LongType()), field("terms", ints), field("impacts", ints), field("norm", T.DoubleType())])
    impacts = map_batches(vectors, _impacts(spark.sparkContext.broadcast(weights), documents, length), schema)
    order = [F.col("norm").desc(), F.col("tie")]
    ordered = impacts.repartitionByRange(*order).sortWithinPartitions(*order).drop("tie").withColumn("bucket", F.shiftright(F.monotonically_increasing_id(), BUCKET_LOG2))
    ordered = materialize(ordered, "by-length")
    first = ordered.agg(F.min("bucket")).first()[0]
    if first is None:
        return None
    result = T.StructType([field("item", T.LongType()), field("score", T.LongType()), field("doc_id", id_type)])
    search = lambda rows: _ranked(map_batches(rows, _search(spark.sparkContext.broadcast((block, root)), k), result), k)
    known = search(ordered.where(F.col("bucket") == first)).where(F.col("rank") == k).select("item", "score").toArrow()
    bounds = dict(zip(known["item"].to_pylist(), known["score"].to_pylist(), strict=True))
    for item in block:
        item.least = bounds.get(item.item, 0)
    shortest = min(item.least / (item.norm * SLACK) for item in block)
    return search(ordered.where(F.col("norm") >= shortest))


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """item_id, rank, doc_id and score of the k best documents for each row of ``items``."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    items = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).cast("string").alias("text"))
    longs = T.ArrayType(T.LongType())
    schema = T.StructType([
        T.StructField("item", T.LongType()), T.StructField("item_id", items.schema["item_id"].dataType, True), T.StructField("terms", longs), T.StructField("times", longs),
    ])
    asked = materialize(map_batches(items, _item_vectors, schema), "items")
    blocks = -(-(asked.agg(F.sum(F.size("terms"))).first()[0] or 0) // BLOCK_TERMS)
    found = None
    for number in range(blocks):
        mine = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == number).select("item", "terms", "times")
        rows = mine.toArrow().to_pylist()
        part = _search_block(docs, rows, k) if rows else None
        if part is not None:
            part = materialize(part, "ranked") if blocks > 1 else part
            found = part if found is None else found.union(part)
    if found is None:
        found = asked.sparkSession.createDataFrame([], T.StructType([
            T.StructField("item", T.LongType()), T.StructField("score", T.LongType()), T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("rank", T.IntegerType()),
        ]))
    return found.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
