"""Stored results of the declared checks, one for each stored folder, and their merger.

Every table of the checks lies in folders (bronze by landed month, marts by trip month).
What the checks find in a folder is stored beside the marts as rows that add up:

* ``states``: the null count of each not-null column, the unexpected values of each
  accepted-values column and, where a folder holds every row of a key (a date in its own
  month), the values that occur twice;
* ``keys``: for unique columns whose values may meet in any folder (ride ids), every value
  with its count, in ``layout.buckets`` buckets by hash, sorted;
* ``repeats``: the values of those columns that occur more than once in all folders.

An entry carries the print of the folder it was made from (names, sizes and times of its
files, and the checks themselves) in its path, so one rename puts both in place.  A refresh
reads the folders whose print has changed, and of the keys of all other folders only the
buckets in which a changed folder has other keys than before: counts of the values that
changed are taken anew, every other repeat stays.  Repeats name the set of entries they
belong to; where a run stopped between the two, they are counted again from the keys.

The report made of this equals the one over whole tables, whatever passed or failed
before.  The driver lists files and holds one print for each folder and the numbers
of the buckets; nulls of a key are no values of it, an empty folder has no entry, a
folder that is gone takes its entry along.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from velomart.operators import quality
from velomart.operators.joins import TRIP_MONTH
from velomart.operators.quality import ACCEPTED_VALUES, DECLARED_CHECKS, NOT_NULL, UNIQUE, Check
from velomart.operators.staging import stage_trips, stage_weather
from velomart.plans.ingest import Layout
from velomart.plans.versions import MartVersion
from velomart.schemas import TRIP_BRONZE_SCHEMA, WEATHER_SCHEMA
from velomart.sources.replace import Folder
from velomart.sources.seed import read_holidays
from velomart.sources.tables import read_bronze

_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # Spark's folder name of a null
_STATE = "column_name string, check_name string, value string, n bigint, part string, print string"
_KEYS = "value string, n bigint, part string, print string, column_name string, bucket int"
_REPEATS = "column_name string, bucket int, value string, n bigint"


@dataclass(frozen=True)
class StoredTable:
    """A table in folders.  ``rows`` has the checked columns and those of the folders;
    ``own_keys`` are unique columns whose equal values always share a folder; ``parts`` the
    folders' paths where they are not all those under ``root``."""

    name: str
    root: str
    rows: DataFrame
    folders: tuple[str, ...]
    own_keys: tuple[str, ...] = ()
    parts: tuple[str, ...] | None = None


def stored_tables(spark: SparkSession, layout: Layout, marts: dict[str, DataFrame] | None = None, version: MartVersion | None = None) -> list[StoredTable]:
    """Staging over bronze and, where they are given, the stored marts of a version."""
    months = ("year", "month")
    trips = read_bronze(spark, layout.trips_bronze, TRIP_BRONZE_SCHEMA)
    weather = read_bronze(spark, layout.weather_bronze, WEATHER_SCHEMA)
    found = [
        StoredTable("stg_trips", layout.trips_bronze, stage_trips(trips, keep=months), months),
        StoredTable("stg_weather_daily", layout.weather_bronze, stage_weather(weather, keep=months), months),
    ]
    for name, rows in (marts or {}).items():
        root = f"{layout.marts.rstrip('/')}/{name}"
        found.append(StoredTable(name, root, rows, (TRIP_MONTH,), ("trip_date",), tuple(version.paths(root, name))))
    return found


def refresh_report(spark: SparkSession, layout: Layout, tables: Sequence[StoredTable], concurrent_jobs: int = 5) -> DataFrame:
    """The check report of the tables (and the holiday seed), from states that are brought
    up to date first; columns as in :func:`quality.check_results`."""
    with ThreadPoolExecutor(max_workers=concurrent_jobs, thread_name_prefix="checks") as pool:
        found = list(pool.map(lambda t: CheckStates(spark, layout, t).refresh(), tables))
    checks = quality.checks_for([t.name for t in tables])
    failing = reduce(DataFrame.unionByName, found)
    failures = F.when(F.col("check_name") == NOT_NULL, F.sum("n")).otherwise(F.count_distinct("value"))
    counted = failing.groupBy("table_name", "column_name", "check_name").agg(failures.alias("failures"))
    keys = ["table_name", "column_name", "check_name"]
    declared = spark.createDataFrame([(c.table, c.column, c.kind) for c in checks], "table_name string, column_name string, check_name string")
    n = F.coalesce("failures", F.lit(0)).cast("bigint")
    report = declared.join(counted, keys, "left").select(*keys, n.alias("failures"), (n == 0).alias("passed"))
    seed = quality.check_results({"holiday_calendar": read_holidays(spark, layout.seed)}, quality.checks_for(["holiday_calendar"]))
    return report.unionByName(seed)


class CheckStates:
    """States, keys and repeats of one table."""

    def __init__(self, spark: SparkSession, layout: Layout, table: StoredTable, checks: Sequence[Check] = DECLARED_CHECKS):
        self.spark = spark
        self.table = table
        self.buckets = layout.buckets
        self.checks = [c for c in checks if c.table == table.name]
        self.keyed = [c.column for c in self.checks if c.kind == UNIQUE and c.column not in table.own_keys]
        self.root = f"{layout.check_root}/{table.name}"

    def refresh(self) -> DataFrame:
        """Brings the stored results up to date and returns the failures they hold:
        table_name, column_name, check_name, value, n (nulls counted in one row)."""
        now = self._prints()
        self._store("states", now, self._found)
        states = self._read("states", _STATE, self._held("states"))
        parts = [states.select("column_name", "check_name", "value", "n")]
        if self.keyed:
            self._store_keys(now)
            repeats = self._read_repeats(self._held("keys"))
            parts.append(repeats.select("column_name", F.lit(UNIQUE).alias("check_name"), "value", "n"))
        failing = reduce(DataFrame.unionByName, parts)
        return failing.select(F.lit(self.table.name).alias("table_name"), *failing.columns)

    # ------------------------------------------------------------------ folders

    def _prints(self) -> dict[str, str]:
        """Label -> print of every folder of the table."""
        if self.table.parts is not None:
            return {_label(path.rpartition("/")[2]): self._print(path) for path in self.table.parts}
        # The session is the file system's; one listing a folder, as a scan makes it.
        below = [("", "")]
        for column in self.table.folders:
            below = [
                (f"{path}/{child}", f"{label}-{_label(child)}" if label else _label(child))
                for path, label in below
                for child in Folder(self.spark, f"{self.table.root.rstrip('/')}{path}").children()
                if child.startswith(f"{column}=")
            ]
        return {label: self._print(f"{self.table.root.rstrip('/')}{path}") for path, label in below}

    def _print(self, path: str) -> str:
        mark = hashlib.sha256(repr((self.checks, self.table.own_keys, self.buckets)).encode())
        for name, size, changed in Folder(self.spark, path).files():
            if not name.startswith(("_", ".")):
                mark.update(f"{name}\n{size}\n{changed}\n".encode())
        return mark.hexdigest()[:32]

    def _held(self, kind: str) -> dict[str, str]:
        """Label -> print of every stored entry."""
        held = {}
        for part in Folder(self.spark, f"{self.root}/{kind}").children():
            if part.startswith("part="):
                for mark in Folder(self.spark, f"{self.root}/{kind}/{part}").children():
                    held[part.removeprefix("part=")] = mark.removeprefix("print=")
        return held

    def _rows_of(self, now: dict[str, str], labels: Iterable[str]) -> DataFrame:
        """Rows of some folders, with their label and print; other folders are not listed."""
        labels = sorted(labels)
        part = F.concat_ws("-", *[F.coalesce(F.col(c).cast("string"), F.lit(_NO_VALUE)) for c in self.table.folders])
        marks = F.create_map(*[F.lit(x) for label in labels for x in (label, now[label])])
        rows = self.table.rows.where(reduce(Column.__or__, [self._in_folder(x) for x in labels]))
        return rows.withColumn("__part", part).withColumn("__print", marks[F.col("__part")])

    def _in_folder(self, label: str) -> Column:
        values = label.split("-") if len(self.table.folders) > 1 else [label]
        tests = [F.col(c).isNull() if v == _NO_VALUE else F.col(c).cast("string") == v for c, v in zip(self.table.folders, values)]
        return reduce(Column.__and__, tests)

    # ------------------------------------------------------------------ entries

    def _changed(self, kind: str, now: dict[str, str]) -> tuple[set[str], set[str]]:
        """Labels whose entry is not of the folder as it is, and labels without a folder."""
        held = self._held(kind)
        return {x for x, mark in now.items() if held.get(x) != mark}, set(held) - set(now)

    def _store(self, kind: str, now: dict[str, str], found) -> None:
        changed, gone = self._changed(kind, now)
        store = Folder(self.spark, f"{self.root}/{kind}")
        written = store.beside()
        try:
            if changed:
                found(self._rows_of(now, changed)).write.partitionBy("part", "print").parquet(written)
            self._put(kind, written, changed | gone)
        finally:
            store.delete(written)

    def _put(self, kind: str, written: str, labels: set[str]) -> None:
        for label in sorted(labels):
            entry = Folder(self.spark, f"{self.root}/{kind}/part={label}")
            if entry.has(f"{written}/part={label}"):
                entry.replace_by(f"{written}/part={label}")
            else:
                entry.remove()

    def _found(self, rows: DataFrame) -> DataFrame:
        """What the checks find in each folder; a folder with rows always has some."""
        group = ["__part", "__print"]
        nulls = [
            F.struct(F.lit(c.column).alias("column_name"), F.lit(NOT_NULL).alias("check_name"), F.lit(None).cast("string").alias("value"), F.count_if(F.col(c.column).isNull()).alias("n"))
            for c in self.checks
            if c.kind == NOT_NULL
        ]
        parts = [rows.groupBy(*group).agg(F.array(*nulls).alias("r")).select(*group, F.inline("r"))]
        for c in self.checks:
            value = F.col(c.column).cast("string")
            if c.kind == ACCEPTED_VALUES:
                kept, least = rows.where(value.isNotNull() & ~F.col(c.column).isin(*c.values)), 0
            elif c.kind == UNIQUE and c.column in self.table.own_keys:
                kept, least = rows.where(value.isNotNull()), 1
            else:
                continue
            counted = kept.groupBy(*group, value.alias("value")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > least)
            parts.append(counted.select(*group, F.lit(c.column).alias("column_name"), F.lit(c.kind).alias("check_name"), "value", "n"))
        found = reduce(DataFrame.unionByName, parts)
        return found.withColumnsRenamed({"__part": "part", "__print": "print"}).hint("rebalance", "part")

    def _read(self, kind: str, schema: str, labels: Iterable[str], at: str | None = None) -> DataFrame:
        labels = sorted(labels)
        if not labels:
            return self.spark.createDataFrame([], schema)
        root = at or f"{self.root}/{kind}"
        paths = [f"{root}/part={label}" for label in labels]
        return self.spark.read.schema(schema).option("basePath", root).parquet(*paths)

    # --------------------------------------------------------------------- keys

    def _keys_of(self, rows: DataFrame) -> DataFrame:
        group = ["__part", "__print"]
        pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in self.keyed])
        values = rows.select(*group, F.inline(pairs)).where(F.col("value").isNotNull())
        counted = values.groupBy(*group, "column_name", "value").agg(F.count(F.lit(1)).alias("n"))
        keys = counted.withColumnsRenamed({"__part": "part", "__print": "print"}).withColumn("bucket", F.pmod(F.xxhash64("column_name", "value"), F.lit(self.buckets)).cast("int"))
        folder = ["part", "print", "column_name", "bucket"]
        return keys.hint("rebalance", *folder).sortWithinPartitions(*folder, "value").select("value", "n", *folder)

    def _store_keys(self, now: dict[str, str]) -> None:
        held = self._held("keys")
        changed, gone = self._changed("keys", now)
        known = Folder(self.spark, f"{self.root}/repeats/of={_digest(held)}").has()
        if known and not changed and not gone:
            return
        store = Folder(self.spark, f"{self.root}/keys")
        written = store.beside()
        try:
            if changed:
                keys = self._keys_of(self._rows_of(now, changed))
                keys.write.partitionBy("part", "print", "column_name", "bucket").parquet(written)
            fresh = {p.removeprefix("part=") for p in Folder(self.spark, written).children() if p.startswith("part=")}
            kept = set(held) - changed - gone
            after = {**{x: held[x] for x in kept}, **{x: now[x] for x in fresh}}
            if after != held or not known:
                new = self._read("keys", _KEYS, fresh, at=written)
                repeats = self.changed_repeats(held, kept, new, set(held) - kept) if known else _repeats(self._read("keys", _KEYS, kept).unionByName(new))
                counts = Folder(self.spark, f"{self.root}/repeats")
                aside = counts.beside()
                try:
                    repeats.write.parquet(f"{aside}/of={_digest(after)}")
                    self._put("keys", written, changed | gone)
                    counts.replace_by(aside)
                finally:
                    counts.delete(aside)
        finally:
            store.delete(written)

    def changed_repeats(self, held: dict[str, str], kept: set[str], new: DataFrame, replaced: set[str]) -> DataFrame:
        """Repeats after the entries ``replaced`` gave way to ``new``, from those before:
        values whose count in a folder changed are counted anew, the others stay."""
        key = ["column_name", "bucket", "value"]
        old = self._read("keys", _KEYS, replaced)
        change = (
            new.select("part", *key, F.col("n"))
            .unionByName(old.select("part", *key, (-F.col("n")).alias("n")))
            .groupBy("part", *key)
            .agg(F.sum("n").alias("n"))
            .where(F.col("n") != 0)
            .select(*key)
            .distinct()
        )
        touched = sorted(r.bucket for r in change.select("bucket").distinct().collect())
        rest = self.kept_keys(kept, touched)
        again = rest.select(*key, "n").join(change, key, "left_semi")
        again = again.unionByName(new.select(*key, "n").join(change, key, "left_semi"))
        stays = self._read_repeats(held).join(change, key, "left_anti")
        return stays.unionByName(_repeats(again))

    def kept_keys(self, labels: Iterable[str], buckets: Sequence[int]) -> DataFrame:
        """Keys of some folders in some buckets: no other folder or bucket is opened."""
        return self._read("keys", _KEYS, labels).where(F.col("bucket").isin(*buckets) if buckets else F.lit(False))

    def _read_repeats(self, held: dict[str, str]) -> DataFrame:
        return self.spark.read.schema(_REPEATS).parquet(f"{self.root}/repeats/of={_digest(held)}")


def _label(folder: str) -> str:
    value = folder.partition("=")[2]
    return str(int(value)) if value.isdigit() else value


def _digest(prints: dict[str, str]) -> str:
    return hashlib.sha256(repr(sorted(prints.items())).encode()).hexdigest()[:32]


def _repeats(keys: DataFrame) -> DataFrame:
    counted = keys.groupBy("column_name", "bucket", "value").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") > 1)
