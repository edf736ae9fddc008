"""Exact dedup by a content sort.

Texts are compared without white space.  The normalised bytes are put in one order:
sampled splitters deal them to ranges, every range is sorted externally, equal texts then
lie side by side, and neighbours are compared byte by byte.  The first row of a run of
equal texts stays: the one of most code points, then of the least id.

* A splitter holds the first 16 normalised bytes and 8 bytes of the digest, then code
  points, id and a running number, so what is sampled to the driver does not grow with the
  texts, texts of one beginning are still split, and a text that a third of all rows hold
  is cut into several ranges.  Inside a range the whole bytes are sorted and compared.
* Within one Arrow batch of sorted rows every run but those at its two ends is whole.  The
  runs at the ends go on with their text, one row each, and are put together by a grouping
  on whole texts: two texts a batch, however many rows a group has.
* Texts are normalised once and stored, so the sample and the sort read the same rows
  also after a lost executor.

Defined cases: null and empty texts and texts of white space alone are equal to each other;
a null id comes after every other; of rows alike in text, length and id one stays, and
``kept`` is true for that row alone; an empty table gives no rows; other columns are
ignored.  Bytes that are no characters cannot occur in a Spark string column.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words
from .common import map_batches, materialize

HEAD_BYTES = 16
DIGEST_BYTES = 8


def normalised(column: pa.Array) -> Iterator[tuple[int, int, pa.Array, np.ndarray]]:
    """First row, end row, the texts without white space, and the code points that the
    whole texts have."""
    for row, end, data, offsets in words.chunks(column):
        inside = words.NOT_SPACE[data]
        gone = np.flatnonzero(~inside)
        bounds = (offsets - np.searchsorted(gone, offsets)).astype(np.int64)
        inner = np.flatnonzero((data & 0xC0) == 0x80)  # bytes within a character
        points = np.diff(offsets - np.searchsorted(inner, offsets))
        texts = pa.Array.from_buffers(pa.large_binary(), end - row, [None, pa.py_buffer(bounds), pa.py_buffer(data[inside])])
        yield row, end, texts, points


def _normalise(keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for batch in batches:
            for row, end, texts, points in normalised(batch.column("text")):
                sha = [hashlib.sha256(memoryview(t.as_buffer())).digest() for t in texts]
                rows = batch.slice(row, end - row)
                order = np.arange(number, number + end - row)
                number += end - row
                yield pa.RecordBatch.from_arrays(
                    [
                        *(rows.column(c) for c in keep),
                        pa.array(points, pa.int64()),
                        texts.cast(pa.binary()),
                        pc.binary_slice(texts, 0, HEAD_BYTES).cast(pa.binary()),
                        pa.array(sha, pa.binary()),
                        pa.array([d[:DIGEST_BYTES] for d in sha], pa.binary()),
                        pa.array(order),
                    ],
                    names=[*keep, "points", "norm", "head", "sha", "digest", "tie"],
                )

    return run


def _runs(keep: list[str]):
    """From sorted rows: of each its run's first id and size; a run at an end of a batch
    has a number instead, and its first row carries the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = TaskContext.get().partitionId() << 40
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            norm, head, digest = (batch.column(c) for c in ("norm", "head", "digest"))
            opens = np.ones(n, bool)
            opens[1:] = ~pc.equal(norm.slice(1), norm.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(opens)
            of = np.cumsum(opens) - 1
            sizes = np.diff(np.append(starts, n))
            # Rows of one range key may go on in the next batch or range, between other
            # texts of the same key: all runs of such a key count as open.
            edge = np.zeros(n, bool)
            for at in (0, n - 1):
                alike = pc.and_(pc.equal(head, head[at]), pc.equal(digest, digest[at]))
                edge |= alike.to_numpy(zero_copy_only=False)
            first = pa.array(starts[of])
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in keep),
                    batch.column("sha"),
                    batch.column(keep[0]).take(first),
                    pa.array(sizes[of]),
                    pa.array(opens),
                    pa.array(numbers + starts[of], mask=~edge),
                    pc.if_else(pa.array(edge & opens), norm, pa.scalar(None, norm.type)),
                ],
                names=[*keep, "sha", "keep_id", "group_size", "kept", "run", "norm"],
            )
            numbers += n

    return run


def equal_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", extra: dict[str, Column] | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 and the columns ``extra`` of each
    row of ``docs``."""
    extra = extra or {}
    keep = ["doc_id", *extra]
    rows = docs.select(F.col(id_col).alias("doc_id"), *(c.alias(n) for n, c in extra.items()), F.col(text_col).cast("string").alias("text"))
    fields = [T.StructField(f.name, f.dataType, True) for f in rows.schema if f.name != "text"]
    made = lambda **types: T.StructType(fields + [T.StructField(n, t, True) for n, t in types.items()])
    long, blob = T.LongType(), T.BinaryType()
    stored = materialize(map_batches(rows, _normalise(keep), made(points=long, norm=blob, head=blob, sha=blob, digest=blob, tie=long)), "normalised")
    later = [F.col("points").desc(), F.col("doc_id").asc_nulls_last(), F.col("tie")]
    dealt = stored.repartitionByRange("head", "digest", *later).sortWithinPartitions("head", "digest", "norm", *later)
    schema = made(sha=blob, keep_id=rows.schema["doc_id"].dataType, group_size=long, kept=T.BooleanType(), run=long, norm=blob)
    found = materialize(map_batches(dealt.drop("points", "tie"), _runs(keep), schema), "runs")
    parts = found.where("norm is not null").select("norm", "run", "keep_id", "group_size")
    whole = parts.groupBy("norm").agg(F.min("run").alias("first_run"), F.min_by("keep_id", "run").alias("group_keep"), F.sum("group_size").alias("size"))
    joined = parts.select("norm", F.col("run").alias("part")).join(whole, "norm").drop("norm")
    part = F.col("run").isNotNull()
    return found.join(joined, F.col("run") == F.col("part"), "left").select(
        "doc_id",
        F.when(part, F.col("group_keep")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.when(part, F.col("size")).otherwise(F.col("group_size")).alias("group_size"),
        (F.col("kept") & (~part | (F.col("run") == F.col("first_run")))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
        *extra,
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    carried = {f"column{i}": F.col(f"`{c}`") for i, c in enumerate(docs.columns)}
    kept = equal_texts(docs, id_col, text_col, carried).where("kept")
    return kept.select(*(F.col(n).alias(c) for n, c in zip(carried, docs.columns, strict=True)))
