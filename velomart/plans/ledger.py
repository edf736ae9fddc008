"""Load ledger: an append-only parquet table of (pipeline, year, month) loads.

Every load appends a small file.  ``compact`` writes the rows of many into one and says so
in an index file, ``_index/<n>``: readers take the rows of the last index's file and the
files that it does not name.  Appends at the same time are not in its list and stay; of two
compactions at once one makes the number.  Replaced files are deleted by the next
compaction, so a reader that began before still finds them.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velomart.schemas import LEDGER_SCHEMA
from velomart.sources.replace import Folder, create_file, read_file
from velomart.sources.tables import path_exists

SUCCESS, FAILED, STALE = "success", "failed", "stale"
MAX_FILES = 64  # of single appends


class LoadLedger:
    """Ledger at ``path`` (shared storage).  Rows are only ever appended."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def read(self) -> DataFrame:
        """All ledger rows; an empty frame with the ledger schema before the first load."""
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], LEDGER_SCHEMA)
        paths, _, _ = self._files()
        return self.spark.read.schema(LEDGER_SCHEMA).parquet(*paths) if paths else self.spark.createDataFrame([], LEDGER_SCHEMA)

    def _files(self) -> tuple[list[str], list[str], int]:
        """Paths that hold the rows, names of replaced files, number of the last index (0: none)."""
        root = self.path.rstrip("/")
        index = Folder(self.spark, f"{root}/_index")

        def latest() -> int:
            return max((int(n) for n in index.children() if n.isdigit()), default=0)

        while True:
            number = latest()
            names = [n for n, _, _ in Folder(self.spark, root).files() if not n.startswith(("_", "."))]
            if latest() == number:  # else the files were listed across a compaction
                break
        if not number:
            return [f"{root}/{n}" for n in names], [], 0
        last = json.loads(read_file(self.spark, f"{index.path}/{number:010d}"))
        replaced = set(last["replaced"])
        return [f"{root}/_compact/{last['rows']}", *(f"{root}/{n}" for n in names if n not in replaced)], last["replaced"], number

    def compact(self, max_files: int = MAX_FILES) -> bool:
        """Puts the rows into one file if there are more than ``max_files`` appended ones;
        True if it did.  A ledger has some rows a load, so one task writes them."""
        if not path_exists(self.spark, self.path):
            return False
        paths, before, number = self._files()
        root = self.path.rstrip("/")
        appended = [p.rpartition("/")[2] for p in paths if "/_compact/" not in p]
        if len(appended) <= max_files:
            return False
        rows = f"{number + 1:010d}-{uuid.uuid4().hex[:12]}"
        folder = Folder(self.spark, f"{root}/_compact/{rows}")
        self.spark.read.schema(LEDGER_SCHEMA).parquet(*paths).coalesce(1).write.parquet(folder.path)
        if not create_file(self.spark, f"{root}/_index/{number + 1:010d}", json.dumps({"rows": rows, "replaced": appended})):
            folder.delete()
            return False
        # What the compaction before replaced, and the rows that it wrote, one step later.
        held = Folder(self.spark, root)
        for name in before:
            held.delete(f"{root}/{name}")
        for kind in ("_compact", "_index"):
            for old in Folder(self.spark, f"{root}/{kind}").children():
                if old.partition("-")[0].isdigit() and int(old.partition("-")[0]) < number:
                    held.delete(f"{root}/{kind}/{old}")
        return True

    def append(self, rows: DataFrame) -> None:
        """Appends rows.  They are written aside and moved in: jobs that append to one
        folder at the same time would delete each other's temporary files."""
        folder = Folder(self.spark, self.path)
        written = folder.beside()
        try:
            rows.select(*[F.col(f.name).cast(f.dataType) for f in LEDGER_SCHEMA.fields]).write.parquet(written)
            folder.add_files(written)
        finally:
            folder.delete(written)

    def record(self, pipeline_name: str, year: int, month: int, output_path: str, status: str = SUCCESS) -> None:
        """Append one load event; ``loaded_at`` is naive UTC wall-clock time."""
        row = [(pipeline_name, int(year), int(month), output_path, status, self.now())]
        self.append(self.spark.createDataFrame(row, LEDGER_SCHEMA).coalesce(1))

    @staticmethod
    def now() -> dt.datetime:
        """Naive UTC wall-clock time, as ``loaded_at`` has it."""
        return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)

    def record_all(self, pipeline_name: str, months, output_path: str, status: str, at: dt.datetime | None = None) -> None:
        """Append one event for each (year, month), of now or of the time ``at``."""
        now = at or self.now()
        rows = [(pipeline_name, int(y), int(m), output_path, status, now) for y, m in sorted(set(months))]
        if rows:
            self.append(self.spark.createDataFrame(rows, LEDGER_SCHEMA).coalesce(1))

    def latest(self, pipeline_name: str) -> DataFrame:
        """(year, month, status) of the latest event of each month."""
        rows = self.read().where(F.col("pipeline_name") == pipeline_name)
        return rows.groupBy("year", "month").agg(F.max(F.struct("loaded_at", "status"))["status"].alias("status"))

    def successes(self, pipeline_name: str | None = None) -> DataFrame:
        ok = self.read().where(F.col("status") == SUCCESS)
        return ok.where(F.col("pipeline_name") == pipeline_name) if pipeline_name else ok

    def already_loaded(self, pipeline_name: str, year: int, month: int) -> bool:
        """True if at least one successful load of that month is recorded (stops at the first)."""
        if not path_exists(self.spark, self.path):
            return False
        hits = self.successes(pipeline_name).where((F.col("year") == year) & (F.col("month") == month))
        return not hits.limit(1).isEmpty()

    def count_loads(self, pipeline_name: str, year: int, month: int) -> int:
        """Number of successful load rows for a month."""
        return (
            self.successes(pipeline_name).where((F.col("year") == year) & (F.col("month") == month)).count()
        )

    def load_counts(self, requested: DataFrame) -> DataFrame:
        """Requested (pipeline_name, year, month) rows with their number of successful
        loads and whether there is one: the set form of both lookups above."""
        keys = ["pipeline_name", "year", "month"]
        counts = self.successes().groupBy(*keys).agg(F.count(F.lit(1)).alias("loads"))
        loads = F.coalesce("loads", F.lit(0))
        return requested.join(counts, keys, "left").select(*keys, (loads > 0).alias("already_loaded"), loads.cast("long").alias("loads"))

    def pending(self, requested: DataFrame) -> DataFrame:
        """Requested (pipeline_name, year, month) rows with no successful load."""
        return pending_months(requested, self.read())


def pending_months(requested: DataFrame, ledger: DataFrame) -> DataFrame:
    """Set form of the "already loaded?" test: requested months anti-joined with
    the successful ledger rows on (pipeline_name, year, month)."""
    keys = ["pipeline_name", "year", "month"]
    done = ledger.where(F.col("status") == SUCCESS).select(*keys).distinct()
    return requested.join(done, on=keys, how="left_anti")
