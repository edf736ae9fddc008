"""Scans and sinks: landing CSV/JSON, bronze and mart parquet, the holiday seed,
and test fixtures derived from the shared tables."""
