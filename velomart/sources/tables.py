"""Parquet tables: month-partitioned bronze, stored marts, CSV export."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from velomart.functions.time import iso_date_text, zero_pad_month
from pyspark.sql.types import StructType

from velomart.schemas import TRIP_BRONZE_SCHEMA, WEATHER_SCHEMA
from velomart.sources.replace import Folder


def path_exists(spark: SparkSession, path: str) -> bool:
    """True if ``path`` holds the result of a committed write: Spark's ``_SUCCESS``
    marker in it, or files under a table root that has the marker."""
    folder = Folder(spark, path)
    folder.recover()
    if not folder.has():
        return False
    if folder.has(f"{folder.path}/_SUCCESS"):
        return True
    root = folder.path.partition("/year=")[0]
    return root != folder.path and folder.has(f"{root}/_SUCCESS") and any(not n.startswith(("_", ".")) for n in folder.children())


def month_partition(root: str, year: int, month: int) -> str:
    return f"{root.rstrip('/')}/year={year:04d}/month={month:02d}"


def write_bronze(
    df: DataFrame,
    root: str,
    year: int | None = None,
    month: int | None = None,
    date_col: str = "started_at",
    ready: Callable[[], None] | None = None,
) -> None:
    """Write rows into ``root/year=YYYY/month=MM`` partitions, replacing only those.

    With (year, month) the partition comes from the run arguments (the landed
    month), as the monthly load does: that one folder is replaced as a whole, even
    when the new landing holds no rows, and only once the new rows are written and
    ``ready`` has not raised, so a failed reload leaves the old month as it was.  Without
    them each row goes to the month of ``date_col`` and dynamic partition
    overwrite replaces exactly the months present.  Other months are untouched
    either way, so a rerun never duplicates rows.
    """
    if year is not None and month is not None:
        folder = Folder(df.sparkSession, month_partition(root, year, month))
        folder.recover()
        written = folder.beside()
        try:
            df.write.parquet(written)
            if ready is not None:
                ready()
            folder.replace_by(written)
        finally:
            folder.delete(written)
        return
    d = F.col(date_col)
    parted = df.withColumn("year", F.year(d).cast("string")).withColumn("month", zero_pad_month(F.month(d)))
    (
        parted.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("year", "month")
        .parquet(root)
    )


def read_bronze(spark: SparkSession, root: str, schema: StructType | None = None) -> DataFrame:
    """All months of a bronze table; ``year``/``month`` are discovered partition
    columns, so a filter on them prunes directories.  With ``schema`` nothing is
    inferred (an emptied month, or a table with no rows yet, still reads)."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.option("basePath", root).parquet(root)


def read_bronze_trips(spark: SparkSession, root: str) -> DataFrame:
    """Trip bronze with its 13 declared columns plus ``year``/``month``."""
    return read_bronze(spark, root, TRIP_BRONZE_SCHEMA)


def read_bronze_weather(spark: SparkSession, root: str) -> DataFrame:
    return read_bronze(spark, root, WEATHER_SCHEMA).select(*WEATHER_SCHEMA.names)


def write_mart(
    df: DataFrame,
    path: str,
    sort_keys: Sequence[Column] = (),
    partition_by: Sequence[str] = (),
    replaced: Sequence[str] | None = None,
    check: Callable[[DataFrame], None] | None = None,
    rebalance: bool = True,
) -> str:
    """Materialise a mart: written aside, checked there, then put in place.

    By default the whole table is replaced.  ``replaced`` names the partition folders
    that ``df`` is the new content of (a refresh of some months): each takes the place
    of the stored one, and is removed where ``df`` has no rows for it.  Until the write
    is committed and ``check`` has passed on it, the stored table is untouched.

    ``rebalance`` lets AQE pick the file count and split a skewed partition into
    several files; without it tasks write what they hold, which suits rows that are
    stored by month already.  Rows are sorted within files by the mart's order so
    parquet min/max statistics skip row groups on date filters.  ``partition_by``
    writes folders that readers prune (statically or dynamically).
    """
    spark = df.sparkSession
    balanced = df
    if rebalance:
        balanced = df.hint("rebalance", *partition_by) if partition_by else df.hint("rebalance")
    if sort_keys:
        # Partition columns lead the sort: the writer needs rows grouped by its
        # partition folders and would otherwise add a sort of its own on top.
        balanced = balanced.sortWithinPartitions(*[F.col(c) for c in partition_by], *sort_keys)
    writer = balanced.write.partitionBy(*partition_by) if partition_by else balanced.write
    table = Folder(spark, path)
    table.recover()
    written = table.beside()
    try:
        writer.parquet(written)
        if check is not None:
            check(spark.read.schema(df.schema).parquet(written))
        if replaced is None or not table.has():
            table.replace_by(written)
        else:
            for name in replaced:
                stored = Folder(spark, f"{table.path}/{name}")
                if stored.has(f"{written}/{name}"):
                    stored.replace_by(f"{written}/{name}")
                else:
                    stored.remove()
    finally:
        table.delete(written)
    return path


def read_mart(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, schema: StructType | None = None
) -> DataFrame:
    """Read a stored mart; ``columns`` restores the mart's column order (partition
    columns come last in a partitioned scan).  With ``schema`` nothing is
    inferred, so a mart rebuilt from no rows still reads (as empty)."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(path)
    return df.select(*columns) if columns else df


def export_csv(df: DataFrame, path: str, date_cols: Sequence[str] = ("trip_date",)) -> str:
    """Write a report frame as one header CSV file (dates as plain ``YYYY-MM-DD``).

    Only for day-grain report frames: one row per calendar day is a proven bound on
    what meets in the one output task; ``repartition`` keeps the aggregation and joins
    before it in their own tasks.
    """
    out = df
    for c in date_cols:
        if c in df.columns:
            out = out.withColumn(c, iso_date_text(c))
    out.repartition(1).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return path


def read_csv_export(spark: SparkSession, path: str, schema) -> DataFrame:
    """Read an exported CSV back with the frame's schema (text dates become DATE)."""
    return spark.read.schema(schema).option("header", True).option("escape", '"').option("mode", "FAILFAST").csv(path)
