"""Trips of both layouts, id eras and rollups, written by hand."""

import datetime as dt
import zipfile

from conftest import rows

from dockwise.operators import clean
from dockwise.operators import trips as t
from dockwise.plans.trips import trip_tables
from dockwise.sources import files

OLD_HEADER = (
    '"tripduration","starttime","stoptime","start station id","start station name","start station latitude",'
    '"start station longitude","end station id","end station name","end station latitude","end station longitude"'
)
NEW_HEADER = (
    "ride_id,rideable_type,started_at,ended_at,start_station_name,start_station_id,end_station_name,"
    "end_station_id,start_lat,start_lng,end_lat,end_lng,member_casual"
)


def write_zip(path, members):
    with zipfile.ZipFile(path, "w") as archive:
        for name, lines in members.items():
            archive.writestr(name, "\n".join(lines) + "\n")


def archives(folder):
    write_zip(
        folder / "202101-tripdata.csv.zip",
        {
            "notes.csv": ["ride_id,started_at", "x,y"],
            "trips.csv": [
                OLD_HEADER,
                '60,"2021-01-05 10:00:00.1230","2021-01-05 10:01:30.4560","72","W 52 St","40.7","-73.9","079","Franklin","40.8","-74.0"',
                '60,"2021-01-06 10:00:00.1230","2021-01-06 10:01:30.4560","079","Franklin","40.8","-74.0","72","W 52 St","40.7","-73.9"',
                '60,"2021-01-07 10:00:00.1230","2021-01-07 10:00:30.4560","72","W 52 St","40.7","-73.9","72","W 52 St","40.7","-73.9"',
            ],
        },
    )
    write_zip(
        folder / "202102-tripdata.csv.zip",
        {
            "trips.csv": [
                NEW_HEADER,
                "r1,classic,2021-02-05 10:00:00,2021-02-05 10:10:00,W 52 St,6926.01,Franklin,5430.10,40.7,-73.9,40.8,-74.0,member",
                "r2,classic,2021-02-06 10:00:00,2021-02-06 10:10:00,Franklin,5430.10,W 52 St,6926.01,40.8,-74.0,40.7,-73.9,casual",
                "r3,classic,2021-02-07 10:00:00,2021-02-07 10:10:00,Franklin,5430.10,,,40.8,-74.0,,,casual",
                "r4,classic,2021-02-08 10:00:00,2021-02-08 10:10:00,Franklin,5430.10,Only End,9.9,40.8,-74.0,1,2,casual",
            ],
        },
    )
    return str(folder / "*.csv.zip")


def test_scan(spark, tmp_path):
    trips = files.scan_trips(spark, archives(tmp_path))
    got = trips.orderBy("started_at").collect()
    assert len(got) == 7  # the largest member of each archive
    assert set(trips.columns) == {*t.TRIP_COLUMNS, "source_file"}
    first, modern = got[0], got[3]
    assert (first.start_station_id, first.end_station_id) == ("72", "079")  # leading zero kept
    assert (first.started_at, first.duration_seconds) == (dt.datetime(2021, 1, 5, 10), 90)
    assert first.rideable_type is None and first.member_casual is None
    assert (modern.start_station_id, modern.end_station_id) == ("6926.01", "5430.10")
    assert (modern.duration_seconds, modern.member_casual) == (600, "member")
    assert t.complete_trips(trips).count() == 6


def test_stations(spark, tmp_path):
    trips = files.scan_trips(spark, archives(tmp_path))
    got = rows(t.stations_of_trips(trips), "station_id", "station_name", "lng")
    assert got == [
        ("079", "Franklin", -74.0), ("5430.10", "Franklin", -74.0), ("6926.01", "W 52 St", -73.9),
        ("72", "W 52 St", -73.9), ("9.9", "Only End", 2.0),
    ]


def test_first_non_null_is_per_column(spark):
    seen = spark.createDataFrame(
        [("k", 1, None, 5), ("k", 2, "a", None), ("k", 3, "b", 6), (None, 1, "z", 1)],
        "id string, at int, name string, size int",
    )
    assert rows(t.first_non_null_per_key(seen, "id", ["name", "size"], ["at"])) == [("k", "a", 5)]


def stations(spark):
    return spark.createDataFrame(
        [("s1", "72", "6926.01", 10), ("s2", "079", "5430.10", 0), ("s3", "9", "9.9", 4)],
        "station_id string, legacy_id string, short_name string, capacity int",
    )


def test_yearly_rollup(spark, tmp_path):
    trips = t.complete_trips(files.scan_trips(spark, archives(tmp_path)))
    got = {r.station_id: r for r in t.trips_summary_year(trips, stations(spark), [2021]).collect()}
    # two ends in January under the old id, two in February under the new one
    assert got["s1"].total_trips == 4
    assert (got["s1"].trips_per_dock, got["s1"].trips_per_day) == (0.4, 4 / 365)
    assert got["s1"].trips_per_day_per_dock == 4 / 3650
    # r4 starts at s2 too, and no docks means no rate
    assert got["s2"].total_trips == 5 and got["s2"].trips_per_dock is None
    # only ends and no starts: no total
    assert got["s3"].total_trips is None and got["s3"].trips_per_day is None


def test_days_that_occur(spark, tmp_path):
    trips = t.complete_trips(files.scan_trips(spark, archives(tmp_path)))
    by_date = t.trips_summary_year(trips, stations(spark), [2021], days={})
    assert by_date.filter("station_id = 's1'").first().trips_per_day == 4 / 6
    assert rows(t.active_days(trips)) == [(6,)]


def test_era(spark, tmp_path):
    trips = t.complete_trips(files.scan_trips(spark, archives(tmp_path)))
    joined = t.join_station_by_id_era(trips, stations(spark))
    got = rows(joined, "start_station_id", "id_era", "station_id")
    assert got == [
        ("079", "legacy", "s2"), ("5430.10", "modern", "s2"), ("5430.10", "modern", "s2"),
        ("6926.01", "modern", "s1"), ("72", "legacy", "s1"), ("72", "legacy", "s1"),
    ]


def test_missing_side(spark):
    places = spark.createDataFrame([("a",), ("b",)], "station_id string")
    starts = spark.createDataFrame([("a", 2)], "station_id string, start_trips long")
    ends = spark.createDataFrame([("a", 3), ("b", 4)], "station_id string, end_trips long")
    assert rows(t.join_starts_ends(places, starts, ends)) == [("a", 5), ("b", None)]
    assert rows(t.join_starts_ends(places, starts, ends, fill_zero=True)) == [("a", 5), ("b", 4)]


def test_all_years(spark):
    yearly = spark.createDataFrame(
        [("a", 2019, 7, 1.0, 0.5), ("a", 2020, None, None, None), ("a", 2021, 8, 2.0, 1.5), ("z", 2021, 1, 1.0, None)],
        "station_id string, year int, total_trips long, trips_per_day double, trips_per_day_per_dock double",
    )
    places = spark.createDataFrame([("a", 4), ("z", 0), ("n", 3)], "station_id string, capacity int")
    got = rows(t.trips_summary_all(yearly, places), "station_id", "total_trips", "trips_per_day", "trips_per_dock")
    assert got == [("a", 15, 1.5, 3), ("n", None, None, None), ("z", 1, 1.0, None)]


def test_pipeline(spark, tmp_path):
    trips = files.scan_trips(spark, archives(tmp_path))
    tables = trip_tables(trips, stations(spark), [2021])
    assert rows(tables["trips_summary"], "station_id", "total_trips", "trips_per_dock") == [
        ("s1", 4, 0), ("s2", 5, None), ("s3", None, None),
    ]


def test_typo(spark):
    rates = spark.createDataFrame([(20.0,), (20.5,), (None,)], "trips_per_day_per_dock double")
    assert rows(clean.fix_capacity_typo(rates)) == [(None,), (2.05,), (20.0,)]
