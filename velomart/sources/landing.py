"""Landing-zone scans: monthly trip CSVs and weather observation pages (JSON)."""

from __future__ import annotations

import csv
import re
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from velomart.schemas import OBSERVATION_PAGE_SCHEMA, TRIP_CSV_TYPES
from velomart.sources import csv_records


def list_csv_files(spark: SparkSession, root: str) -> list[str]:
    """All ``*.csv`` files below ``root`` (recursive), from Spark's file index.

    ``inputFiles`` lists the files the scan would read without reading any data; its
    names are percent-encoded, and are decoded here to be read as they are.
    """
    files = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .text(root)
        .inputFiles()
    )
    return sorted(unquote(f) for f in files)


def _csv_reader(spark: SparkSession, multi_line: bool = True):
    # Quotes inside fields are doubled in these files; Spark's default escape
    # is a backslash, so set it to the quote character.  Columns are not pruned while
    # parsing: a row of too few fields must fail whichever columns are asked for.
    return (
        spark.read.option("header", True)
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .option("columnPruning", False)
        .option("multiLine", multi_line)
    )


def csv_headers(spark: SparkSession, files: list[str]) -> dict[str, tuple[str, ...]]:
    """Column names of each CSV file: one job over the first lines of all files.

    A line's number within its file is its place in the scan; only the first block of
    each file can hold the first line, and one row per file is collected.
    """
    return {file: header for file, (header, _) in _headers_and_sizes(spark, files).items()}


def _headers_and_sizes(spark: SparkSession, files: list[str]) -> dict[str, tuple[tuple[str, ...], int]]:
    lines = spark.read.text([_literal(f) for f in files]).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"), "value",
    )
    first = lines.where("block = 0").groupBy("file").agg(F.min_by("value", "place").alias("header"), F.max("size").alias("size"))
    found = {_plain(unquote(r.file)): (tuple(next(csv.reader([r.header.lstrip("\ufeff")]))), r.size) for r in first.collect()}
    return {f: found[_plain(f)] for f in files if _plain(f) in found}


def _plain(path: str) -> str:
    """One spelling of a path: ``file:/x`` and ``file:///x`` are the same."""
    return re.sub(r"^(\w+):/+", r"\1:/", path)


def _literal(path: str) -> str:
    """``path`` without the special meaning of glob characters."""
    return "".join("\\" + c if c in "*?[]{}" else c for c in path)


#: Types of unlisted columns, narrowest first: the text they take, and Spark's name.
SNIFFED = (
    ("boolean", r"(?i)true|false|t|f"),
    ("date", r"[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"),
    ("timestamp_ntz", r"[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?"),
    ("bigint", r"-?(0|[1-9][0-9]{0,18})"),
    ("decimal(38,0)", r"-?(0|[1-9][0-9]{0,37})"),
    ("double", r"-?((0|[1-9][0-9]*)(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?"),
)


def sniff_types(df: DataFrame, columns: list[str]) -> dict[str, str]:
    """The narrowest type that takes every value of each text column: one aggregate of a
    flag per column and type, so one row leaves Spark.  An integer is also a double;
    numbers with leading zeros or a plus, mixed kinds and nulls alone stay text."""
    if not columns:
        return {}
    tests = []
    for i, column in enumerate(columns):
        value = F.col(f"`{column}`")
        tests.append(F.count(value).alias(f"n{i}"))
        for kind, pattern in SNIFFED:
            fits = value.rlike(f"^({pattern})$") & value.try_cast(kind).isNotNull()
            tests.append(F.bool_and(F.when(value.isNotNull(), fits)).alias(f"{kind}{i}"))
    found = df.agg(*tests).first()
    fitting = {c: [kind for kind, _ in SNIFFED if found[f"n{i}"] and found[f"{kind}{i}"]] for i, c in enumerate(columns)}
    return {c: (kinds or ["string"])[0] for c, kinds in fitting.items()}


def _split_bytes(spark: SparkSession) -> int:
    """The size up to which a file is one task whatever it holds."""
    return int(spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes")))


def _parsed(spark: SparkSession, header: tuple[str, ...], sizes: dict[str, int], multi_line: bool, split: bool) -> DataFrame:
    """All columns as text, of files of one header."""
    schema = T.StructType([T.StructField(name, T.StringType()) for name in header])
    # The names are those of the group, so the header lines need not repeat their case.
    scan = lambda paths, lines: _csv_reader(spark, lines).option("enforceSchema", True).schema(schema).csv([_literal(p) for p in paths])
    if not multi_line:
        return scan(list(sizes), False)
    large = [p for p, size in sizes.items() if size > _split_bytes(spark)] if split else []
    shapes = csv_records.file_shapes(spark, [_literal(p) for p in large]) if large else {}
    by_path = {_plain(unquote(file)): (file, shape) for file, shape in shapes.items()}
    plain, cut, whole = [], {}, [p for p in sizes if p not in large]
    for path in large:
        file, shape = by_path[_plain(path)]
        if shape.stray or len(cut) + len(shape.starts) > csv_records.MOST_RANGES:
            whole.append(path)
        elif shape.broken_lines:
            cut[path] = (file, shape)
        else:
            plain.append(path)
    parts = [scan(paths, lines) for paths, lines in ((whole, True), (plain, False)) if paths]
    if cut:
        rows = csv_records.records(spark, [_literal(p) for p in cut], dict(cut.values()))
        columns = ", ".join(f"`{name.replace('`', '``')}` STRING" for name in header)
        options = {"escape": '"', "mode": "FAILFAST", "multiLine": "true", "columnPruning": "false"}
        parts.append(rows.select(F.from_csv("record", columns, options).alias("r")).select("r.*"))
    return reduce(DataFrame.unionByName, parts)


def read_trip_csvs(spark: SparkSession, root_or_files: str | list[str], multi_line: bool = True, split: bool = True, sniff: bool = True) -> DataFrame:
    """Typed trip rows from every CSV below a landing folder, matched by header name.

    Files are grouped by their header; each group is scanned once, all columns as
    text, and the groups are combined with ``unionByName(allowMissingColumns=True)`` so a
    column missing from one file is null there and a different column order never
    misplaces values.  Names of the 13 known columns match in any case; one that no file
    has is an error.  They are cast with ANSI semantics (bad text fails the job).  Other
    columns get the narrowest type that all their values fit (``sniff``, one aggregate over
    the files that have such columns); without it they stay text.

    Fields may hold line breaks in quotes.  A file of more than
    ``spark.sql.files.maxPartitionBytes`` is split all the same: one aggregate finds
    whether its lines break fields and in which state each byte range begins
    (``csv_records``).  ``multi_line=False`` saves that scan for files known to have no
    such fields; ``split=False`` makes every file one task.  A file with quotes inside bare
    fields is one task too.
    """
    files = list_csv_files(spark, root_or_files) if isinstance(root_or_files, str) else list(root_or_files)
    if not files:
        raise ValueError(f"no CSV files under {root_or_files}")
    known_names = {name.lower(): name for name in TRIP_CSV_TYPES}
    groups: dict[tuple[str, ...], dict[str, int]] = {}
    for path, (header, size) in _headers_and_sizes(spark, files).items():
        groups.setdefault(tuple(known_names.get(name.lower(), name) for name in header), {})[path] = size

    absent = [name for name in TRIP_CSV_TYPES if not any(name in header for header in groups)]
    if absent:
        raise ValueError(f"no CSV file under {root_or_files} has the columns {', '.join(absent)}")
    parts = {header: _parsed(spark, header, sizes, multi_line, split) for header, sizes in groups.items()}
    union = lambda frames: reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    raw = union(parts.values())
    extra = [n for n in raw.columns if n not in TRIP_CSV_TYPES]
    types = dict.fromkeys(extra, "string")
    if sniff and extra:
        types = sniff_types(union([df for header, df in parts.items() if set(header) & set(extra)]), extra)
    known = [F.col(n).cast(t).alias(n) for n, t in TRIP_CSV_TYPES.items()]
    return raw.select(*known, *(F.col(f"`{n}`").cast(types[n]).alias(n) for n in extra))


def write_trip_csv(df: DataFrame, path: str, columns: list[str] | None = None) -> str:
    """Write trips as header CSV files (used to land test data)."""
    out = df.select(*(columns or df.columns))
    out.write.mode("overwrite").option("header", True).option("escape", '"').option(
        "timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS"
    ).csv(path)
    return path


#: Places in a page leave room for so many records before the next page's.
PAGE_ROOM = 1 << 32


def read_observation_pages(spark: SparkSession, path: str, station: str | None = None) -> DataFrame:
    """Long-form observations (obs_date, datatype, value, seq) from landed JSON pages.

    Each landed file is one API page ``{"results": [...]}``, in any layout of lines;
    files that Spark wrote (``part-*``) hold one page a line, with its number as
    ``page``.  ``seq`` orders records by page and position, which reproduces the record
    order of the paged download and makes "first value" deterministic: pages without a
    number are numbered in the order of their paths.  A page that cannot be parsed, or
    has no ``results``, fails the job.  ``station`` keeps one station when pages hold
    several.
    """
    reader = spark.read.schema(OBSERVATION_PAGE_SCHEMA).option("mode", "FAILFAST")
    file = F.col("_metadata.file_path").alias("file")
    written = F.col("_metadata.file_name").startswith("part-")
    lines = reader.json(path).where(written).select("page", "results", file)
    landed = reader.option("multiLine", True).json(path).where(~written).select("page", "results", file)
    # One row per landed file.
    order = landed.select("file").distinct().withColumn("number", F.row_number().over(Window.orderBy("file")).cast("long"))
    numbered = landed.join(order, "file").select(F.coalesce("page", "number").alias("page"), "results", "file")
    results = F.coalesce("results", F.raise_error(F.concat(F.lit("no results in page "), "file")).cast(landed.schema["results"].dataType))
    rows = lines.union(numbered).select("page", F.posexplode(results).alias("pos", "r"))
    if station is not None:
        rows = rows.where(F.col("r.station") == station)
    return rows.select(
        F.col("r.date").cast("timestamp_ntz").cast("date").alias("obs_date"),
        F.col("r.datatype").alias("datatype"),
        F.col("r.value").alias("value"),
        (F.col("page") * F.lit(PAGE_ROOM) + F.col("pos")).alias("seq"),
    )


def write_observation_pages(
    observations: DataFrame, path: str, station: str = "GHCND:TEST", page_size: int = 1000, files: int = 8
) -> str:
    """Land observations as JSON pages of at most ``page_size`` records, for tests.

    ``seq`` must be a dense integer order (the fixture uses the event id): page
    ``k`` holds seq values ``[k*page_size, (k+1)*page_size)``, sorted, so every
    collected page is bounded by ``page_size``.  Pages carry their number and are
    written as JSON lines by Spark tasks, into at most ``files`` files.
    """
    record = F.struct(
        F.date_format("obs_date", "yyyy-MM-dd'T'HH:mm:ss").alias("date"),
        F.col("datatype"),
        F.lit(station).alias("station"),
        F.lit(",,W,2400").alias("attributes"),
        F.col("value"),
    )
    pages = (
        observations.groupBy(F.floor(F.col("seq") / page_size).alias("page"))
        .agg(F.sort_array(F.collect_list(F.struct(F.col("seq"), record.alias("rec")))).alias("items"))
        .select("page", F.col("items.rec").alias("results"))
    )
    pages.coalesce(files).write.mode("overwrite").json(path)
    return path
