"""Benchmark decontamination by winnowing.

Of every 13 consecutive words the smallest k-gram hash is kept (k = 7, so a window
holds 7 grams): two texts that share 13 words share a kept gram of that span, which
guarantees every sufficiently long match.  Benchmark items of fewer words are one
window of their own length, winnowed with grams of about half of it.

Documents are read once.  A Bloom filter of fixed size, made from the benchmark's kept
grams, lets through the documents' grams that may match; these carry the words around
them (up to the span on either side) into an exact join with the benchmark's grams, and
each pair is extended word by word.  A run of a whole window is a hit.  Benchmark
contexts are joined once each, however many items share them, and the items of a
document are found per distinct set of matched contexts, so a passage in a third of all
documents and in many items never makes all pairs of the two.

Defined cases: a null or wordless text has no words, no hits and is clean; a benchmark
row without words matches nothing; one without an id contaminates but counts as no item;
repeated ids count once; equal rows get equal results; an empty table on either side is
no special case; columns beyond id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from . import bloom, words
from .common import map_batches, materialize, row_key

WINDOW = 13


def gram_of(span: int) -> int:
    """Words of a gram for spans of this many words."""
    return (span + 1) // 2


def kept_grams(hashes: np.ndarray, first: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the grams that are the least of a window of ``span``
    words; ``first`` has the first word of each text, plus the end."""
    n, k = len(hashes), gram_of(span)
    grams = words.mix(words.gram_hashes(hashes, k) + np.uint64(span))
    ends = np.repeat(first[1:], np.diff(first))
    valid = np.arange(n) + span <= ends
    least = np.where(valid, words.sliding_min(grams, span - k + 1), np.uint64(0))
    kept = np.flatnonzero((words.sliding_max_back(least, span - k + 1) == grams) & (grams != 0))
    return kept, grams[kept]


def _context(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, at: int, low: int, high: int, span: int) -> tuple[int, str]:
    """How many words stand before the gram, and the words around it, between the
    text's first and end word, as far as a span with the gram can reach."""
    k = gram_of(span)
    a, b = max(low, at - (span - k)), min(high, at + span)
    return at - a, b" ".join(data[s:e].tobytes() for s, e in zip(starts[a:b], ends[a:b], strict=True)).decode("utf-8", "replace")


def _words(data: np.ndarray, offsets: np.ndarray):
    low = words.LOWER[data]
    starts, ends, first = words.spans(low, offsets, words.LETTERS_AND_DIGITS)
    return low, starts, ends, first, words.span_hashes(low, starts, ends)


ITEM_SCHEMA = T.StructType([
    T.StructField("item", T.StringType()), T.StructField("fp", T.LongType()), T.StructField("span", T.IntegerType()),
    T.StructField("at", T.IntegerType()), T.StructField("context", T.StringType()),
])


def _item_grams(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("item")
            for row, end, data, offsets in words.chunks(batch.column("text")):
                low, starts, ends, first, hashes = _words(data, offsets)
                for i in range(end - row):
                    a, b = first[i], first[i + 1]
                    if a == b:
                        continue
                    span = int(min(window, b - a))
                    at, fps = kept_grams(hashes[a:b], np.array([0, b - a]), span)
                    around = [_context(low, starts, ends, a + p, a, b, span) for p in at]
                    yield pa.RecordBatch.from_arrays(
                        [pa.repeat(ids[row + i], len(at)), words.signed(fps), pa.array([span] * len(at), pa.int32()), pa.array([x for x, _ in around], pa.int32()), pa.array([x for _, x in around], pa.string())],
                        names=["item", "fp", "span", "at", "context"],
                    )

    return run


def item_grams(benchmark: DataFrame, id_col: str, text_col: str, window: int = WINDOW) -> DataFrame:
    """item, fp, span, at, context: the kept grams of the benchmark."""
    items = benchmark.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    return map_batches(items, _item_grams(window), ITEM_SCHEMA)


def _document_grams(bits, spans: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = batch.column("doc_id"), batch.column("rk")
            for row, end, data, offsets in words.chunks(batch.column("text")):
                low, starts, ends, first, hashes = _words(data, offsets)
                doc = np.repeat(np.arange(row, end), np.diff(first))
                count = pa.array(np.diff(first), pa.int64())
                nothing = [pa.nulls(end - row, t) for t in (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.string())]
                names = ["doc_id", "rk", "n_words", "fp", "span", "pos", "at", "context"]
                yield pa.RecordBatch.from_arrays([ids.slice(row, end - row), keys.slice(row, end - row), count, *nothing], names=names)
                for span in spans:
                    at, fps = kept_grams(hashes, first, span)
                    hit = words_in(bits, fps)
                    at, fps = at[hit], fps[hit]
                    if not len(at):
                        continue
                    owner = doc[at]
                    start = first[owner - row]
                    around = [_context(low, starts, ends, p, s, e, span) for p, s, e in zip(at, start, first[owner - row + 1], strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.nulls(len(at), ids.type), keys.take(pa.array(owner)), pa.nulls(len(at), pa.int64()), words.signed(fps), pa.array([span] * len(at), pa.int32()), pa.array(at - start, pa.int64()), pa.array([x for x, _ in around], pa.int32()), pa.array([x for _, x in around], pa.string())],
                        names=names,
                    )

    def words_in(sent, fps):
        return bloom.passes(sent.value, fps)

    return run


def extend(left: list[str], at: int, right: list[str], to: int, k: int) -> tuple[int, int]:
    """How many words before and from the gram on agree, the gram included; (0, 0) if
    the grams themselves differ."""
    if left[at : at + k] != right[to : to + k]:
        return 0, 0
    before, after = 0, k
    while before < at and before < to and left[at - 1 - before] == right[to - 1 - before]:
        before += 1
    while at + after < len(left) and to + after < len(right) and left[at + after] == right[to + after]:
        after += 1
    return before, after


def _extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            before, after = extend(row["context"].split(" "), row["at"], row["item_context"].split(" "), row["item_at"], gram_of(row["span"]))
            if before + after >= row["span"]:
                out.append((row["rk"], row["cid"], row["pos"] - before, row["pos"] + after))
        cols = list(zip(*out, strict=True)) if out else [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=["rk", "cid", "low", "high"])


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", window: int = WINDOW) -> DataFrame:
    """doc_id, rk (key of the row's id and text), n_words, n_hit, n_items, item_ids."""
    spark = docs.sparkSession
    grams = materialize(item_grams(benchmark, item_col, text_col, window), "item-grams")
    spans = sorted(row.span for row in grams.select("span").distinct().collect())  # at most `window` values
    bits = spark.sparkContext.broadcast(bloom.build(grams, "fp"))  # fixed size
    grams = grams.withColumn("cid", F.xxhash64("span", "at", "context"))
    contexts = grams.select("fp", "span", "cid", F.col("at").alias("item_at"), F.col("context").alias("item_context")).distinct()
    items = grams.where("item is not null").select("cid", "item").distinct()

    rows = docs.select(F.col(id_col).alias("doc_id"), row_key(id_col, text_col).alias("rk"), F.col(text_col).alias("text"))
    schema = T.StructType([
        rows.schema["doc_id"], T.StructField("rk", T.StringType()), T.StructField("n_words", T.LongType()), T.StructField("fp", T.LongType()),
        T.StructField("span", T.IntegerType()), T.StructField("pos", T.LongType()), T.StructField("at", T.IntegerType()), T.StructField("context", T.StringType()),
    ])
    found = materialize(map_batches(rows, _document_grams(bits, spans), schema), "document-grams")
    base = found.where("n_words is not null").select("doc_id", "rk", "n_words")
    pairs = found.where("fp is not null").select("rk", "fp", "span", "pos", "at", "context").join(contexts, ["fp", "span"])
    runs = materialize(map_batches(pairs, _extend, "rk string, cid long, low long, high long").distinct(), "runs")

    nearer = Window.partitionBy("rk").orderBy("low", "high").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.lit(0), F.col("high") - F.greatest("low", F.coalesce(F.max("high").over(nearer), F.col("low"))))
    hits = runs.select("rk", "low", "high").distinct().select("rk", fresh.alias("fresh")).groupBy("rk").agg(F.sum("fresh").alias("n_hit"))
    sets = runs.groupBy("rk").agg(F.sort_array(F.collect_set("cid")).alias("cids")).withColumn("set", F.md5(F.array_join(F.col("cids").cast("array<string>"), ",").cast("binary")))
    lists = (
        sets.groupBy("set").agg(F.first("cids").alias("cids"))
        .select("set", F.explode("cids").alias("cid"))
        .join(items, "cid")
        .groupBy("set").agg(F.sort_array(F.collect_set("item")).alias("item_ids"))
    )
    named = sets.select("rk", "set").join(lists, "set", "left").join(hits, "rk")
    return base.join(named, "rk", "left").select(
        "doc_id", "rk", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"), F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
    ).withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words")))
