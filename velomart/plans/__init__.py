"""Jobs that write: the load ledger, monthly ingest, and the build-all job."""
