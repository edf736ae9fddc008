"""CSV files with line breaks in quotes, read in several tasks.

A line starts inside a quoted field when an odd number of quotes lies before it in its
file; a doubled quote counts twice and changes nothing.  So one aggregate over the lines
(the parity of the quotes of each byte range), a running sum of those parities, and every
range knows how it begins.  Each task then cuts its lines at the unquoted line ends.  What
a range holds of a record that another range began or ends is at most two pieces, which are
put together by a grouping.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from velomart.session import ship_package

#: Fields bare or in quotes, up to the end of the record.
_FIELD = r'(?:"[^"]*(?:""[^"]*)*"|[^",]*)'
WELL_FORMED = rf"^{_FIELD}(?:,{_FIELD})*\r?$"
#: A quote between two characters that neither open nor close a field.
STRAY = r'[^,"]"[^,"\r]'
#: Byte ranges whose first quote state is sent to the tasks (a few bytes each).
MOST_RANGES = 1 << 20


@dataclass
class FileShape:
    """What the quotes of a file say about how it can be read."""

    broken_lines: bool = False  # a line with an odd number of quotes
    stray: bool = False
    crlf: bool = False  # its first line ends with both characters, which then mean one
    starts: dict[int, int] = field(default_factory=dict)  # range: 1 where it begins in quotes


def text_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """file, block (where its byte range begins) and value of each line."""
    lines = spark.read.option("lineSep", "\n").text(paths)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def file_shapes(spark: SparkSession, paths: list[str]) -> dict[str, FileShape]:
    """The shape of each file: one aggregate, one row a byte range to the driver."""
    quotes = F.length("value") - F.length(F.translate("value", '"', ""))
    ranges = (
        text_lines(spark, paths)
        .select("file", "block", quotes.alias("quotes"), F.col("value").rlike(STRAY).alias("stray"), F.col("value").endswith("\r").alias("cr"), F.monotonically_increasing_id().alias("place"))
        .groupBy("file", "block")
        .agg(F.min_by("cr", "place").alias("cr"), (F.sum("quotes") % 2).alias("odd"), F.max(F.col("quotes") % 2).alias("broken"), F.max("stray").alias("stray"))
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    out: dict[str, FileShape] = {}
    for r in ranges.withColumn("start", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2).toLocalIterator():
        shape = out.setdefault(r.file, FileShape())
        shape.broken_lines |= bool(r.broken)
        shape.stray |= bool(r.stray)
        shape.starts[r.block] = int(r.start)
        shape.crlf |= r.block == 0 and r.cr
    return out


def _cut(starts: dict[tuple[str, int], int], crlf: set[str]):
    """Whole records, and pieces (``piece`` 0: the end of a record that an earlier range
    began, 1: the beginning of one that goes on) of each byte range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: tuple[str, int] | None = None
        held = pa.array([], pa.string())  # lines of a record without its end so far
        carried = header = False  # whether an earlier range began it; whether the header is still to come

        def rows(records: pa.Array, piece: int | None) -> pa.RecordBatch:
            n = len(records)
            columns = [pa.array([now[0]] * n, pa.string()), pa.array([now[1]] * n, pa.int64()), pa.array([piece] * n, pa.int32()), records]
            return pa.RecordBatch.from_arrays(columns, names=["file", "block", "piece", "record"])

        def whole(records: pa.Array) -> pa.Array:
            quoted = records.filter(pc.match_substring(records, '"'))
            if not pc.all(pc.match_substring_regex(quoted, WELL_FORMED), min_count=0).as_py():
                raise ValueError(f"a quote within a bare field in {now[0]}: read it with split=False")
            records = pc.replace_substring_regex(records, "\r$", "")
            records = records.filter(pc.not_equal(records, ""))
            return pc.replace_substring(records, "\r\n", "\n") if now[0] in crlf else records

        def cut(lines: pa.Array) -> Iterator[pa.RecordBatch]:
            nonlocal held, carried, header
            lines = pa.concat_arrays([held, lines])
            odd = pc.count_substring(lines, '"').to_numpy() % 2
            odd[0] += carried  # its range begins in quotes
            ends = np.flatnonzero(np.cumsum(odd) % 2 == 0) + 1
            if not len(ends):
                held = lines
                return
            bounds = pa.array(np.append(0, ends), pa.int32())
            joined = pc.binary_join(pa.ListArray.from_arrays(bounds, lines.slice(0, int(ends[-1]))), "\n")
            held = lines.slice(int(ends[-1]))
            if carried:
                yield rows(joined.slice(0, 1), 0)
                carried, joined = False, joined.slice(1)
            elif header:
                header, joined = False, joined.slice(1)
            yield rows(whole(joined), None)

        def close() -> Iterator[pa.RecordBatch]:
            if len(held):
                yield rows(pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(held)], pa.int32()), held), "\n"), 0 if carried else 1)

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column("block").to_numpy(), pc.dictionary_encode(batch.column("file")).indices.to_numpy()
            cuts = np.flatnonzero((keys[0][1:] != keys[0][:-1]) | (keys[1][1:] != keys[1][:-1])) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
                here = batch.column("file")[a].as_py(), batch.column("block")[a].as_py()
                if now != here:
                    yield from close()
                    now = here
                    if now not in starts:
                        raise ValueError(f"byte ranges of {now[0]} changed while it was read")
                    held, carried, header = held.slice(0, 0), bool(starts[now]), now[1] == 0
                yield from cut(batch.column("value").slice(a, b - a))
        yield from close()

    return run


def records(spark: SparkSession, paths: list[str], shapes: dict[str, FileShape]) -> DataFrame:
    """One row ``record`` for each record of the files, header records left out."""
    starts = {(file, block): start for file, shape in shapes.items() for block, start in shape.starts.items()}
    crlf = {file for file, shape in shapes.items() if shape.crlf}
    ship_package(spark)
    cut = text_lines(spark, paths).mapInArrow(_cut(starts, crlf), "file string, block long, piece int, record string")
    # A record over ranges begins with a piece 1 and takes the pieces 0 up to the next 1.
    place = Window.partitionBy("file").orderBy("block", "piece")
    numbered = cut.where("piece is not null").withColumn("number", F.sum("piece").over(place.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    joined = numbered.groupBy("file", "number").agg(F.sort_array(F.collect_list(F.struct("block", "piece", "record"))).alias("pieces"))
    text = F.concat_ws("\n", F.transform("pieces", lambda p: p["record"]))
    quotes = F.length("text") - F.length(F.translate("text", '"', ""))
    checked = F.when(quotes % 2 == 0, F.rtrim("text", F.lit("\r"))).otherwise(F.raise_error(F.concat(F.lit("a quoted field without an end in "), "file")).cast("string"))
    ends = F.when(F.col("file").isin(sorted(crlf)), F.replace(checked, F.lit("\r\n"), F.lit("\n"))).otherwise(checked)
    over = joined.select("file", text.alias("text")).select(ends.alias("record"))
    return cut.where("piece is null").select("record").union(over)
