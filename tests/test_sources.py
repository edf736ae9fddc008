"""Landing scans, bronze partitions, seed and weather pivot."""

import datetime as dt
import json
import os

import pytest

from velomart.operators.weather import pivot_observations
from velomart.sources.landing import read_observation_pages, read_trip_csvs
from velomart.sources.seed import read_holidays, write_seed_csv
from velomart.sources.tables import month_partition, path_exists, read_bronze, write_bronze


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)


def test_csv_union_by_header_name(spark, scratch):
    root = scratch("csv")
    _write(
        f"{root}/a/part1.csv",
        "ride_id,rideable_type,started_at,ended_at,start_station_name,start_station_id,"
        "end_station_name,end_station_id,start_lat,start_lng,end_lat,end_lng,member_casual\n"
        'A1,classic_bike,2024-05-01 10:00:00,2024-05-01 10:10:00,"Main St, ""North""",6140.10,'
        "Park,5000.05,40.7,-73.9,40.8,-73.95,member\n",
    )
    _write(
        f"{root}/b/nested/part2.csv",
        "member_casual,end_lng,end_lat,start_lng,start_lat,end_station_id,end_station_name,"
        "start_station_id,start_station_name,ended_at,started_at,rideable_type,ride_id,bike_color\n"
        "casual,-73.5,40.5,-73.6,40.6,0042,Pier,07,Dock,2024-05-02 08:30:00.5,2024-05-02 08:00:00,"
        "electric_bike,B2,red\n",
    )
    _write(f"{root}/b/notes.txt", "not a csv\n")
    df = read_trip_csvs(spark, root)
    rows = {r.ride_id: r for r in df.collect()}
    assert set(rows) == {"A1", "B2"}
    a, b = rows["A1"], rows["B2"]
    assert a.start_station_id == "6140.10" and a.start_station_name == 'Main St, "North"'
    assert a.bike_color is None and b.bike_color == "red"
    assert b.end_station_id == "0042" and b.start_station_id == "07"
    assert b.ended_at == dt.datetime(2024, 5, 2, 8, 30, 0, 500000)
    assert b.start_lat == 40.6 and b.member_casual == "casual"
    assert dict(df.dtypes)["started_at"] == "timestamp_ntz"
    assert dict(df.dtypes)["end_lat"] == "double"


def test_csv_bad_timestamp_fails(spark, scratch):
    root = scratch("csvbad")
    _write(f"{root}/x.csv", "ride_id,started_at\nX,not-a-time\n")
    with pytest.raises(Exception):
        read_trip_csvs(spark, root).collect()


def test_bronze_rerun_replaces_only_its_month(spark, scratch):
    root = scratch("bronze")
    rows = [("r1", dt.datetime(2024, 1, 3, 9)), ("r2", dt.datetime(2024, 2, 3, 9))]
    df = spark.createDataFrame(rows, "ride_id string, started_at timestamp_ntz")
    write_bronze(df.where("ride_id = 'r1'"), root, 2024, 1)
    write_bronze(df.where("ride_id = 'r2'"), root, 2024, 2)
    write_bronze(df.where("ride_id = 'r1'"), root, 2024, 1)
    back = read_bronze(spark, root)
    assert sorted((r.ride_id, r.year, r.month) for r in back.collect()) == [("r1", 2024, 1), ("r2", 2024, 2)]
    assert path_exists(spark, month_partition(root, 2024, 1))
    assert os.path.isdir(month_partition(root, 2024, 2).replace("file:", ""))
    assert not path_exists(spark, month_partition(root, 2024, 3))
    # partition pruning on the discovered columns
    assert back.where("month = 2").count() == 1


def test_seed_roundtrip(spark, scratch):
    path = write_seed_csv(spark, scratch("seed"))
    df = read_holidays(spark, path)
    assert dict(df.dtypes) == {"holiday_date": "date", "holiday_name": "string", "is_holiday": "boolean"}
    rows = df.collect()
    assert len(rows) == 33 and all(r.is_holiday for r in rows)
    assert len({r.holiday_date for r in rows}) == 33
    assert read_holidays(spark).count() == 33


def test_json_pages_and_pivot_first_non_null(spark, scratch):
    root = scratch("json")
    page1 = {
        "results": [
            {"date": "2024-03-01T00:00:00", "datatype": "TMAX", "station": "S1", "value": None},
            {"date": "2024-03-01T00:00:00", "datatype": "TMIN", "station": "S1", "value": -1.5},
            {"date": "2024-03-01T00:00:00", "datatype": "TAVG", "station": "S1", "value": 3.0},
        ]
    }
    page2 = {
        "results": [
            {"date": "2024-03-01T00:00:00", "datatype": "TMAX", "station": "S1", "value": 5.0},
            {"date": "2024-03-01T00:00:00", "datatype": "TMAX", "station": "S1", "value": 7.0},
            {"date": "2024-03-02T00:00:00", "datatype": "PRCP", "station": "S2", "value": 1.0},
            {"date": "2024-03-03T00:00:00", "datatype": "SNOW", "station": "S1", "value": None},
        ]
    }
    _write(f"{root}/page-000001.json", json.dumps(page1, indent=2))
    _write(f"{root}/page-001001.json", json.dumps(page2, indent=2))
    obs = read_observation_pages(spark, root, station="S1")
    wide = {r.weather_date: r for r in pivot_observations(obs).collect()}
    assert set(wide) == {dt.date(2024, 3, 1)}  # day 3 is all-null, day 2 is another station
    day = wide[dt.date(2024, 3, 1)]
    assert day.temperature_max_c == 5.0 and day.temperature_min_c == -1.5
    assert day.snowfall_mm is None and day.avg_wind_speed_mps is None


def test_pivot_order_is_by_seq(spark):
    obs = spark.createDataFrame(
        [(dt.date(2024, 1, 1), "TMAX", 9.0, 20), (dt.date(2024, 1, 1), "TMAX", 4.0, 10)],
        "obs_date date, datatype string, value double, seq long",
    )
    assert pivot_observations(obs).first().temperature_max_c == 4.0


def test_clear_scratch_removes_only_issued_folders(spark, scratch):
    from velomart.session import clear_scratch

    mine, kept = scratch("mine"), scratch("kept")
    spark.range(3).write.parquet(mine)
    spark.range(3).write.parquet(kept)
    foreign = os.path.join(os.path.dirname(mine), "not-issued")
    assert clear_scratch(spark, [mine, foreign]) == 1
    assert not os.path.exists(mine) and os.path.exists(kept)
    assert clear_scratch(spark, [mine]) == 0
    assert clear_scratch(spark, [kept]) == 1 and not os.path.exists(kept)


HEADER = "ride_id,rideable_type,started_at,ended_at,start_station_name,start_station_id,end_station_name,end_station_id,start_lat,start_lng,end_lat,end_lng,member_casual"
ROW = "A1,classic_bike,2024-03-01 10:00:00,2024-03-01 10:10:00,S,1,T,2,40.1,-74.1,40.2,-74.2,member"


def test_header_names_match_in_any_case(spark, scratch):
    root = scratch("case")
    _write(f"{root}/a.csv", HEADER.replace("ride_id", "Ride_ID") + "\n" + ROW + "\n")
    df = read_trip_csvs(spark, root)
    assert df.first().ride_id == "A1" and df.columns.count("ride_id") == 1 and len(df.columns) == 13


def test_declared_column_absent_from_all_files_fails(spark, scratch):
    root = scratch("absent")
    _write(f"{root}/a.csv", "x,y\n1,2\n")
    with pytest.raises(ValueError, match="ride_id"):
        read_trip_csvs(spark, root)


def test_quoted_line_break_and_short_row(spark, scratch):
    root = scratch("quoted")
    _write(f"{root}/a.csv", HEADER + "\n" + ROW.replace(",S,", ',"S\nquay",') + "\n")
    assert [r.start_station_name for r in read_trip_csvs(spark, root).select("start_station_name").collect()] == ["S\nquay"]
    short = scratch("short")
    _write(f"{short}/a.csv", HEADER + "\n" + ROW + "\nA2,classic_bike\n")
    for broken in (read_trip_csvs(spark, short).select("ride_id"), read_trip_csvs(spark, short, multi_line=False)):
        with pytest.raises(Exception, match="MALFORMED|Malformed"):
            broken.collect()
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        read_trip_csvs(spark, short).count()


def test_space_in_a_landing_path(spark, scratch):
    root = scratch("space") + "/my folder"
    _write(f"{root}/a file.csv", HEADER + "\n" + ROW + "\n")
    assert read_trip_csvs(spark, root).count() == 1


def test_truncated_page_and_page_without_results_fail(spark, scratch):
    for name, text in (("cut", '{"results": [{"date": "2024-03-01T00:00:00", "datatype"'), ("none", '{"error": 1}')):
        root = scratch(name)
        _write(f"{root}/page-1.json", text)
        with pytest.raises(Exception, match="MALFORMED|Malformed|no results"):
            read_observation_pages(spark, root).collect()


def test_pages_are_few_files_and_pivot_hashes(spark, scratch):
    from velomart.operators.weather import pivot_observations
    from velomart.sources.landing import write_observation_pages

    obs = spark.range(5000).selectExpr("date'2024-03-01' AS obs_date", "'TMAX' AS datatype", "cast(id AS double) AS value", "id AS seq")
    root = scratch("pages")
    write_observation_pages(obs, root, page_size=10)
    assert len([f for f in os.listdir(root) if f.startswith("part-")]) <= 8
    wide = pivot_observations(read_observation_pages(spark, root))
    assert wide.first().temperature_max_c == 0.0
    assert "SortAggregate" not in wide._jdf.queryExecution().executedPlan().toString()
