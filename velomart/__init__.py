"""velomart: a Spark-native batch analytics engine for bike-share trips.

Layers, each a set of ``DataFrame -> DataFrame`` functions:

* ``velomart.sources``   -- landing CSV / JSON scans, bronze and mart parquet I/O,
  the holiday seed, and test fixtures derived from the shared tables.
* ``velomart.functions`` -- Column helpers (time, calendar, day part, ratios).
* ``velomart.operators`` -- staging, marts, weather pivot, reports, quality checks.
* ``velomart.plans``     -- jobs that write: load ledger, monthly ingest, build-all.
"""

from velomart.session import build_session, clear_scratch, scratch_path

__all__ = ["build_session", "clear_scratch", "scratch_path"]
