"""Claims of a month by concurrent loads, and compaction of the ledger."""

import threading
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from velomart.catalog import Inputs
from velomart.plans import ingest
from velomart.plans.claims import Claim, ClaimLostError, claimed
from velomart.plans.ledger import SUCCESS, LoadLedger
from velomart.plans.monthly import monthly_load
from velomart.plans.versions import current
from velomart.sources import landing
from velomart.sources.replace import Folder
from velomart.sources.tables import read_bronze_trips

from tables_at import SF_SMALL

YEAR, MONTH = 2024, 3


@pytest.fixture()
def layout(spark, scratch):
    root = scratch("claims")
    names = ("trips_landing", "weather_landing", "trips_bronze", "weather_bronze", "marts", "ledger")
    lay = ingest.Layout(**{n: f"{root}/{n}" for n in names})
    i = Inputs(spark, SF_SMALL)
    march = (F.year("started_at") == YEAR) & (F.month("started_at") == MONTH)
    landing.write_trip_csv(i.bronze_trips.where(march), lay.landed(lay.trips_landing, YEAR, MONTH))
    landing.write_observation_pages(i.observations, lay.landed(lay.weather_landing, YEAR, MONTH))
    return lay


def test_one_of_many_has_a_claim(spark, scratch):
    root = scratch("one")
    claims = [Claim(spark, root, "m") for _ in range(8)]
    with ThreadPoolExecutor(8) as pool:
        taken = list(pool.map(Claim.take, claims))
    assert sum(taken) == 1
    holder = claims[taken.index(True)]
    assert holder.held() and not Claim(spark, root, "m").take()
    assert Claim(spark, root, "other").take()
    holder.release()
    holder.release()
    with claimed(spark, root, "m") as claim:
        assert claim.held()
        with claimed(spark, root, "m") as second:
            assert second is None
    with pytest.raises(RuntimeError, match="stop"), claimed(spark, root, "m"):
        raise RuntimeError("stop")
    assert Claim(spark, root, "m").take()
    assert len([n for n in Folder(spark, f"{root}/m").children() if n.isdigit()]) == 1


def test_a_lost_run_is_taken_over_and_finds_out(spark, scratch):
    root = scratch("over")
    lost = Claim(spark, root, "m", hours=0)
    assert lost.take() and lost.held()
    other = Claim(spark, root, "m")
    assert other.take() and not lost.held()
    with pytest.raises(ClaimLostError):
        lost.assert_held()
    lost.release()  # not its claim any more
    assert other.held()


def test_concurrent_loads_of_a_month_are_one_load(spark, layout, monkeypatch):
    """Four loads begin together, with and without ``force``; one waits inside its write
    until the others have answered."""
    answered = threading.Semaphore(0)
    write = ingest.write_bronze

    def slow(*args, **kw):
        for _ in range(3):
            assert answered.acquire(timeout=120)
        write(*args, **kw)

    monkeypatch.setattr(ingest, "write_bronze", slow)

    def load(force):
        out = ingest.ingest_trips_month(spark, layout, LoadLedger(spark, layout.ledger), YEAR, MONTH, force)
        answered.release()
        return out

    with ThreadPoolExecutor(4) as pool:
        outcomes = list(pool.map(load, [False, True, False, True]))
    assert sorted(outcomes) == sorted([ingest.LOADED] + [ingest.SKIPPED_CLAIMED] * 3)
    assert LoadLedger(spark, layout.ledger).count_loads(ingest.TRIPS_PIPELINE, YEAR, MONTH) == 1
    trips = read_bronze_trips(spark, layout.trips_bronze)
    assert trips.count() == trips.select("ride_id").distinct().count() > 0
    monkeypatch.setattr(ingest, "write_bronze", write)
    assert load(False) == ingest.SKIPPED_EXISTS


def test_rows_of_a_lost_claim_are_not_put_in_place(spark, layout, monkeypatch):
    read = ingest.read_trip_csvs

    def taken_over(*args):
        name = ingest.claim_name(ingest.TRIPS_PIPELINE, YEAR, MONTH)
        other = Claim(spark, layout.claim_root, name)
        last, _ = other._last()
        assert other._make(last + 1, {"run": "other", "until": "2999-01-01T00:00:00+00:00"})
        return read(*args)

    monkeypatch.setattr(ingest, "read_trip_csvs", taken_over)
    ledger = LoadLedger(spark, layout.ledger)
    with pytest.raises(ClaimLostError):
        ingest.ingest_trips_month(spark, layout, ledger, YEAR, MONTH)
    assert not Folder(spark, f"{layout.trips_bronze}/year=2024/month=03").has()
    assert ledger.read().isEmpty()


def test_a_month_that_another_run_loads_is_left_to_it(spark, layout):
    name = ingest.claim_name(ingest.TRIPS_PIPELINE, YEAR, MONTH)
    with claimed(spark, layout.claim_root, name):
        out = monthly_load(spark, layout, YEAR, MONTH, check=False)
    assert out["trips"] == ingest.SKIPPED_CLAIMED and out["months"] == [] and current(spark, layout) is None
    out = monthly_load(spark, layout, YEAR, MONTH, check=False)
    assert out["trips"] == ingest.LOADED and (YEAR, MONTH) in out["months"]


def test_compaction_keeps_rows_and_bounds_files(spark, scratch):
    ledger = LoadLedger(spark, scratch("ledger"))
    assert not ledger.compact(max_files=0)
    done = 0
    for k in range(12):
        ledger.record("p", 2000 + k, 1, "x")
        early = ledger.read()
        done += ledger.compact(max_files=3)
        # A reader of before, over one compaction, and one of after.
        assert early.count() == ledger.read().count() == k + 1
        files = [n for n, _, _ in Folder(spark, ledger.path).files() if n.endswith(".parquet")]
        assert len(files) <= 8 and len(Folder(spark, f"{ledger.path}/_compact").children()) <= 2
    assert done == 3
    assert sorted(r.year for r in ledger.successes("p").collect()) == list(range(2000, 2012))
    ledger.record_all("p", [(2000, 1)], "x", "failed")
    assert ledger.count_loads("p", 2000, 1) == 1 and ledger.read().where(F.col("status") != SUCCESS).count() == 1


def test_compactions_and_appends_at_once(spark, scratch):
    ledger = LoadLedger(spark, scratch("ledger"))
    ledger.record("p", 1999, 1, "x")

    def work(k):
        if k % 3 == 0:
            return ledger.compact(max_files=1)
        ledger.record("p", 2000 + k, 1, "x")

    with ThreadPoolExecutor(6) as pool:
        list(pool.map(work, range(18)))
    assert sorted(r.year for r in ledger.read().collect()) == [1999, *(2000 + k for k in range(18) if k % 3)]
