"""Files with quoted line breaks read in several tasks, and types of unlisted columns."""

import datetime as dt
import os
import random

import duckdb
import pytest

from velomart.sources import csv_records
from velomart.sources.landing import list_csv_files, read_trip_csvs, sniff_types

HEADER = "ride_id,rideable_type,started_at,ended_at,start_station_name,start_station_id,end_station_name,end_station_id,start_lat,start_lng,end_lat,end_lng,member_casual"


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as fh:
        fh.write(text)


def _row(i, name, end="\n"):
    return f"A{i},classic_bike,2024-03-01 10:00:00,2024-03-01 10:10:00,{name},{i},T,2,40.1,-74.1,40.2,-74.2,member{end}"


def _quoted(text):
    return '"' + text.replace('"', '""') + '"'


def _names(seed, count):
    rnd = random.Random(seed)
    pieces = ["Main St", "\n", "\r\n", '"', ",", " quay ", "é", "\n\n", "x" * 40]
    out = []
    for _ in range(count):
        kind = rnd.random()
        text = "".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 6)))
        out.append("" if kind < 0.1 else "Dock" if kind < 0.5 else _quoted(text) if text else "Pier")
    return out


@pytest.fixture()
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    for n in names:
        spark.conf.set(n, "700")
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("seed, end", [(1, "\n"), (2, "\r\n"), (3, "\n")])
def test_split_file_equals_the_whole_reader(spark, scratch, small_splits, seed, end):
    root = scratch("split")
    _write(f"{root}/a.csv", HEADER + end + "".join(_row(i, n, end) for i, n in enumerate(_names(seed, 400))))
    _write(f"{root}/b.csv", HEADER + end + "".join(_row(1000 + i, "Plain", end) for i in range(50)))
    cut, whole = read_trip_csvs(spark, root), read_trip_csvs(spark, root, split=False)
    assert cut.dtypes == whole.dtypes
    assert _rows(cut) == _rows(whole) and cut.count() == 450
    assert cut.rdd.getNumPartitions() > 20


def test_field_over_many_ranges(spark, scratch, small_splits):
    root = scratch("long")
    long = "\n".join(f"line {i}, of a \"name\"" for i in range(300))
    _write(f"{root}/a.csv", HEADER + "\n" + "".join(_row(i, _quoted(long) if i in (3, 4, 9) else "S") for i in range(12)))
    rows = read_trip_csvs(spark, root).select("ride_id", "start_station_name").collect()
    assert {r.ride_id: r.start_station_name for r in rows} == {f"A{i}": long if i in (3, 4, 9) else "S" for i in range(12)}


def test_last_record_without_a_line_end(spark, scratch, small_splits):
    root = scratch("end")
    _write(f"{root}/a.csv", HEADER + "\n" + "".join(_row(i, '"a\nb"') for i in range(40)) + _row(40, '"c\nd"', ""))
    assert read_trip_csvs(spark, root).count() == 41


def test_stray_quotes_go_to_the_whole_reader_or_fail(spark, scratch, small_splits):
    root = scratch("stray")
    _write(f"{root}/a.csv", HEADER + "\n" + "".join(_row(i, ['5"x', '"a\nb"', "S"][i % 3]) for i in range(60)))
    assert _rows(read_trip_csvs(spark, root)) == _rows(read_trip_csvs(spark, root, split=False))
    root = scratch("ends")
    _write(f"{root}/a.csv", HEADER + "\n" + "".join(_row(i, ['"a\nb"', '5"'][i > 30]) for i in range(60)))
    with pytest.raises(Exception, match="quote"):
        read_trip_csvs(spark, root).collect()
    assert read_trip_csvs(spark, root, split=False).count() == 60


def test_short_row_and_open_quote_fail(spark, scratch, small_splits):
    good = "".join(_row(i, '"a\nb"') for i in range(40))
    for name, tail in (("short", "A2,classic_bike\n"), ("open", _row(50, '"never closed\n'))):
        root = scratch(name)
        _write(f"{root}/a.csv", HEADER + "\n" + good + tail + good)
        with pytest.raises(Exception, match="MALFORMED|Malformed|quote"):
            read_trip_csvs(spark, root).select("ride_id").collect()


def test_shapes(spark, scratch, small_splits):
    root = scratch("shapes")
    _write(f"{root}/plain.csv", HEADER + "\n" + "".join(_row(i, '"a ""b"" c"') for i in range(60)))
    _write(f"{root}/broken.csv", HEADER + "\n" + _row(0, _quoted("x\n" * 900)))
    shapes = {os.path.basename(f): s for f, s in csv_records.file_shapes(spark, list_csv_files(spark, root)).items()}
    assert not shapes["plain.csv"].broken_lines and set(shapes["plain.csv"].starts.values()) == {0}
    assert shapes["broken.csv"].broken_lines and sum(shapes["broken.csv"].starts.values()) >= 1
    assert not any(s.stray for s in shapes.values())


COLUMNS = {
    "whole": ["1", "-20", None, "9000000000"],
    "part": ["1", "2.5", None, "1e3"],
    "day": ["2024-01-31", None, "2024-02-29", "1999-12-31"],
    "moment": ["2024-01-31 10:11", "2024-01-31 10:11:12", None, "2024-01-31 10:11:12.5"],
    "flag": ["true", "false", None, "TRUE"],
    "mixed": ["1", "x", None, "2"],
    "day_or_moment": ["2024-01-31", "2024-01-31 10:11:12", None, None],
    "not_a_day": ["2024-01-31", "2024-02-30", None, None],
    "nothing": [None] * 4,
    "too_big": ["99999999999999999999", "1", None, None],
    "padded": ["007", "12", None, None],
    "plus": ["+1", "12", None, None],
}


def test_sniffed_types(spark, scratch):
    rows = list(zip(*COLUMNS.values(), strict=True))
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in COLUMNS))
    types = sniff_types(df, list(COLUMNS))
    assert types == {
        "whole": "bigint", "part": "double", "day": "date", "moment": "timestamp_ntz", "flag": "boolean", "mixed": "string",
        "day_or_moment": "string", "not_a_day": "string", "nothing": "string", "too_big": "decimal(38,0)", "padded": "string", "plus": "string",
    }


def test_types_are_those_of_duckdb(spark, scratch):
    root = scratch("sniff")
    extra = COLUMNS
    _write(f"{root}/a.csv", HEADER + "\n" + _row(0, "S"))
    lines = [_row(i + 1, "S", "") + "," + ",".join(v[i] or "" for v in extra.values()) + "\n" for i in range(4)]
    _write(f"{root}/b.csv", HEADER + "," + ",".join(extra) + "\n" + "".join(lines))
    df = read_trip_csvs(spark, root)
    got = dict(df.dtypes)
    names = {"BIGINT": "bigint", "HUGEINT": "decimal(38,0)", "DOUBLE": "double", "DATE": "date", "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean", "VARCHAR": "string"}
    want = {r[0]: names[r[1]] for r in duckdb.sql(f"DESCRIBE SELECT * FROM read_csv_auto('{root}/*.csv', union_by_name=true)").fetchall()}
    assert {c: got[c] for c in extra} == {c: want[c] for c in extra}
    rows = {r.ride_id: r for r in df.collect()}
    assert rows["A1"].day == dt.date(2024, 1, 31) and rows["A0"].day is None and rows["A4"].whole == 9_000_000_000
    text = dict(read_trip_csvs(spark, root, sniff=False).dtypes)
    assert all(text[c] == "string" for c in extra)
