"""Versions of the marts: one switch for all of them, conflicts and cleaning."""

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from velomart.catalog import Inputs
from velomart.operators import marts
from velomart.operators.weather import pivot_observations
from velomart.plans import build, versions
from velomart.plans.ingest import Layout
from velomart.plans.versions import ConcurrentBuildError
from velomart.sources.replace import Folder, create_file, read_file
from velomart.sources.tables import write_bronze

from tables_at import SF_SMALL

MARTS = ("a", "b")


def _layout(root):
    names = ("trips_landing", "weather_landing", "trips_bronze", "weather_bronze", "marts", "ledger")
    return Layout(**{n: f"{root}/{n}" for n in names})


def _month(year, month):
    return (F.year("started_at") == year) & (F.month("started_at") == month)


@pytest.fixture()
def built(spark, scratch):
    """Marts of three months, built."""
    lay = _layout(scratch("versions"))
    i = Inputs(spark, SF_SMALL)
    for month in (2, 3, 4):
        write_bronze(i.bronze_trips.where(_month(2024, month)), lay.trips_bronze, 2024, month)
    spring = i.observations.where("year(obs_date) = 2024 and month(obs_date) in (2, 3, 4)")
    write_bronze(pivot_observations(spring), lay.weather_bronze, date_col="weather_date")
    build.build_marts(spark, lay, check=False)
    return lay


def _rows(frames):
    return {name: sorted(map(str, df.collect())) for name, df in frames.items()}


def _empty_march(spark, lay):
    write_bronze(Inputs(spark, SF_SMALL).bronze_trips.limit(0), lay.trips_bronze, 2024, 3)


@pytest.mark.parametrize("months", [None, [(2024, 3)]])
def test_a_build_that_stops_between_marts_leaves_the_version_of_before(spark, built, monkeypatch, months):
    before = _rows(build.load_marts(spark, built))
    assert all(before.values())
    _empty_march(spark, built)

    def stop(staged):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(marts, "flows_daily", stop)
        with pytest.raises(RuntimeError, match="lost"):
            build.build_marts(spark, built, check=False, months=months)
    assert _rows(build.load_marts(spark, built)) == before
    assert versions.published(spark, built) == [1]
    # Nothing of the stopped build is left, and the next one is seen whole.
    held = versions.current(spark, built)
    for name in build.MART_ORDER:
        builds = Folder(spark, f"{built.marts}/{name}").children()
        assert {b for b in builds if b.startswith("build=")} == {f"build={b}" for b in held.folders[name].values()}
    build.build_marts(spark, built, check=False, months=[(2024, 3)])
    after = build.load_marts(spark, built)
    assert all(df.where(_in_march()).isEmpty() and not df.isEmpty() for df in after.values())


def _in_march():
    return (F.year("trip_date") == 2024) & (F.month("trip_date") == 3)


def test_readers_keep_their_version_over_one_switch(spark, built):
    frames = build.load_marts(spark, built)
    before = {name: df.count() for name, df in frames.items()}
    _empty_march(spark, built)
    build.build_marts(spark, built, check=False, months=[(2024, 3)])
    assert {name: df.count() for name, df in frames.items()} == before
    assert {name: df.count() for name, df in build.load_marts(spark, built, version=1).items()} == before
    now = {name: df.count() for name, df in build.load_marts(spark, built).items()}
    assert all(now[name] < before[name] for name in before)
    # Unchanged months are shared, not copied.
    held = versions.read_version(spark, built, 1).folders["fct_trips"]
    kept = versions.current(spark, built).folders["fct_trips"]
    assert kept == {m: b for m, b in held.items() if m != "trip_month=2024-03-01"}
    # Later versions drop the folders that only the first one named.
    build.build_marts(spark, built, check=False, months=[(2024, 2)])
    assert versions.published(spark, built) == [2, 3]
    build.build_marts(spark, built, check=False, months=[(2024, 4)])
    root = f"{built.marts}/fct_trips"
    named = {p for n in (3, 4) for p in versions.read_version(spark, built, n).paths(root, "fct_trips")}
    builds = [b for b in Folder(spark, root).children() if b.startswith("build=")]
    stored = {f"{root}/{b}/{m}" for b in builds for m in Folder(spark, f"{root}/{b}").children() if m.startswith("trip_month=")}
    assert stored == named and len(named) == 3  # April twice
    assert {name: df.count() for name, df in build.load_marts(spark, built).items()} == now


def test_marts_before_any_build_are_an_error(spark, scratch):
    lay = _layout(scratch("none"))
    assert versions.current(spark, lay) is None
    with pytest.raises(FileNotFoundError, match="no version"):
        build.load_marts(spark, lay)


def test_builds_of_other_months_meet_in_one_version(spark, scratch):
    lay = _layout(scratch("meet"))
    both = {m: ["x=1", "x=2", "x=3"] for m in MARTS}
    base = versions.publish(spark, lay, None, "b0", both)
    assert (base.number, base.changed) == (1, None)
    first = versions.publish(spark, lay, base, "b1", {m: ["x=1"] for m in MARTS}, ["x=1"])
    # Begun from the same version: another month goes on top, the same one is refused.
    second = versions.publish(spark, lay, base, "b2", {"a": ["x=2"], "b": []}, ["x=2"])
    assert (first.number, second.number) == (2, 3)
    assert second.folders == {"a": {"x=1": "b1", "x=2": "b2", "x=3": "b0"}, "b": {"x=1": "b1", "x=3": "b0"}}
    for changed in (["x=1", "x=3"], None):
        with pytest.raises(ConcurrentBuildError, match="changed months"):
            versions.publish(spark, lay, base, "b3", both, changed)
    # A version that is gone can't be compared with.
    versions.clean(spark, lay, MARTS, keep=1)
    with pytest.raises(ConcurrentBuildError, match="came and went"):
        versions.publish(spark, lay, base, "b4", {"a": ["x=3"], "b": []}, ["x=3"])
    assert versions.current(spark, lay) == second


def test_many_builds_at_once_lose_no_month(spark, scratch):
    lay = _layout(scratch("many"))
    months = [f"x={k}" for k in range(12)]
    base = versions.publish(spark, lay, None, "b", {"a": months})
    with ThreadPoolExecutor(12) as pool:
        done = list(pool.map(lambda m: versions.publish(spark, lay, base, f"n{m}", {"a": [m]}, [m]).number, months))
    assert sorted(done) == list(range(2, 14))
    assert versions.current(spark, lay).folders == {"a": {m: f"n{m}" for m in months}}


def test_a_file_is_made_once(spark, scratch):
    path = f"{scratch('once')}/claim"
    with ThreadPoolExecutor(8) as pool:
        made = list(pool.map(lambda k: create_file(spark, path, str(k)), range(8)))
    assert sum(made) == 1 and read_file(spark, path) == str(made.index(True))
    assert [n for n in Folder(spark, path.rpartition("/")[0]).children() if not n.startswith(".")] == ["claim"]


def test_cleaning_spares_young_builds(spark, scratch):
    lay = _layout(scratch("clean"))
    now = dt.datetime.now(dt.timezone.utc)
    young, old = (f"{t.strftime('%Y%m%d%H%M%S')}-{k}" for k, t in (("young", now), ("old", now - dt.timedelta(days=3))))
    shared = f"{(now - dt.timedelta(days=9)).strftime('%Y%m%d%H%M%S')}-shared"
    for b in (young, old, shared):
        spark.range(1).write.parquet(f"{lay.marts}/a/build={b}/x=1")
    versions.publish(spark, lay, None, shared, {"a": ["x=1"]})
    assert versions.clean(spark, lay, ["a"]) == [f"{lay.marts}/a/build={old}/x=1"]
    assert Folder(spark, f"{lay.marts}/a").children() == sorted([f"build={young}", f"build={shared}"])
