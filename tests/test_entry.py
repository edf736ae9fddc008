"""Driver contract: entry, queries and oracle SQL agree (sf0.001)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as E  # noqa: E402

from tables_at import SF_SMALL  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert rows and "total_trips" in df.columns and "season" in df.columns


def test_every_query_has_an_oracle():
    from velomart.catalog import QUERIES

    assert set(QUERIES) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize(
    "name",
    ["trip_daily", "station_hourly", "flows_hourly", "daily_enriched", "kpis", "top_flows_hourly", "quality_report"],
)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    norm = lambda v: round(v, 9) if isinstance(v, float) else v
    got = sorted((tuple(norm(r[c]) for c in sorted(ocols)) for r in df.collect()), key=repr)
    want = sorted(
        (tuple(norm(row[ocols.index(c)]) for c in sorted(ocols)) for row in res.fetchall()), key=repr
    )
    assert got == want
