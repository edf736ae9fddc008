"""Data-quality checks with clean and broken rows."""

import datetime as dt

import pytest

from velomart.catalog import Inputs
from velomart.operators import quality

from tables_at import SF_SMALL


def test_declared_check_count():
    assert len(quality.DECLARED_CHECKS) == 59
    kinds = [c.kind for c in quality.DECLARED_CHECKS]
    assert kinds.count("not_null") == 50 and kinds.count("unique") == 6 and kinds.count("accepted_values") == 3


def test_report_on_fixture_flags_unknown_riders(spark):
    i = Inputs(spark, SF_SMALL)
    report = {(r.table_name, r.column_name, r.check_name): r for r in quality.check_results(i.checked_tables()).collect()}
    assert len(report) == 59
    bad = {k for k, r in report.items() if not r.passed}
    assert ("stg_trips", "member_casual", "accepted_values") in bad
    # hourly flows keep trips with missing station names, so their name checks fail
    assert ("fct_station_flows_hourly", "start_station_name", "not_null") in bad
    unexpected = quality.unexpected_values(i.checked_tables()).collect()
    assert [(r.column_name, r.value) for r in unexpected] == [("member_casual", "unknown")]


def test_broken_rows(spark):
    trips = spark.createDataFrame(
        [("1", "member"), ("1", "casual"), ("2", None), (None, "casual"), ("3", "tourist"), ("4", "tourist")],
        "ride_id string, member_casual string",
    )
    checks = [
        quality.Check("t", "ride_id", quality.NOT_NULL),
        quality.Check("t", "member_casual", quality.NOT_NULL),
        quality.Check("t", "ride_id", quality.UNIQUE),
        quality.Check("t", "member_casual", quality.ACCEPTED_VALUES, ("member", "casual")),
    ]
    rep = {(r.column_name, r.check_name): r.failures for r in quality.check_results({"t": trips}, checks).collect()}
    assert rep == {
        ("ride_id", "not_null"): 1,
        ("member_casual", "not_null"): 1,
        ("ride_id", "unique"): 1,
        ("member_casual", "accepted_values"): 1,
    }
    dups = quality.duplicate_values({"t": trips}, checks).collect()
    assert [(r.value, r.n_records) for r in dups] == [("1", 2)]
    with pytest.raises(quality.DataQualityError, match="ride_id unique"):
        quality.assert_checks_pass(quality.check_results({"t": trips}, checks))


def test_clean_rows_pass_the_gate(spark):
    days = spark.createDataFrame([(dt.date(2024, 1, 1), 3), (dt.date(2024, 1, 2), 4)], "trip_date date, n long")
    checks = [quality.Check("d", "trip_date", quality.NOT_NULL), quality.Check("d", "trip_date", quality.UNIQUE)]
    quality.assert_checks_pass(quality.check_results({"d": days}, checks))


def test_collected_report_equals_lazy_report(spark):
    i = Inputs(spark, SF_SMALL)
    tables = i.checked_tables()
    lazy = sorted(tuple(r) for r in quality.check_results(tables).collect())
    collected = sorted(tuple(r) for r in quality.collect_check_results(tables))
    assert lazy == collected and len(collected) == 59


def test_unique_check_reaches_the_rest_of_a_split_table(spark):
    schema = "ride_id string, member_casual string"
    checked = spark.createDataFrame([("a", "member"), ("b", "member"), ("b", "casual"), ("c", "member")], schema)
    rest = spark.createDataFrame([("a", "member"), ("x", "casual"), ("x", "casual"), (None, "casual")], schema)
    checks = [quality.Check("t", "ride_id", quality.UNIQUE)]
    alone = quality.check_results({"t": checked}, checks).collect()
    assert [r.failures for r in alone] == [1]
    # "a" is shared with the rest, "b" repeats within the slice; "x" repeats
    # only within the rest, which passed before, and is not counted again
    split = quality.check_results({"t": checked}, checks, rest={"t": rest}).collect()
    assert [r.failures for r in split] == [2]
    dups = quality.duplicate_values({"t": checked}, checks, rest={"t": rest}).collect()
    assert sorted((r.value, r.n_records) for r in dups) == [("a", 2), ("b", 2)]
    rows = quality.collect_check_results({"t": checked}, checks, rest={"t": rest})
    assert [r.failures for r in rows] == [2]
