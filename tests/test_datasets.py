"""Raw files to layers, dataset by dataset."""

import gzip
import json

from conftest import rows
from test_files import HEADER
from test_status import CAPTURES, SEVEN, station, write_captures
from test_trips import archives

from dockwise.operators import grid as g
from dockwise.plans import datasets as b
from dockwise.plans import siting as s
from dockwise.sources.files import scan_layer

INFO = {
    "external_id": "e", "name": "n", "station_type": "classic", "eightd_has_key_dispenser": False,
    "has_kiosk": True, "electric_bike_surcharge_waiver": False, "rental_methods": ["KEY"],
}


def write_info(path):
    stations = [
        {**INFO, "station_id": "s", "legacy_id": "72", "short_name": "6926.01", "capacity": 10, "lon": -73.99, "lat": 40.75},
        {**INFO, "station_id": "t", "legacy_id": "079", "short_name": "5430.10", "capacity": 0, "lon": -73.98, "lat": 40.76},
        {**INFO, "station_id": "far", "legacy_id": "1", "short_name": "1.1", "capacity": 5, "lon": -75.5, "lat": 40.75},
    ]
    with gzip.open(path, "wt") as out:
        json.dump({"data": {"stations": stations}}, out, indent=1)


def write_boundary(path):
    ring = [[-74.1, 40.6], [-73.8, 40.6], [-73.8, 40.9], [-74.1, 40.9], [-74.1, 40.6]]
    feature = {"properties": {"boro_code": "1"}, "geometry": {"type": "Polygon", "coordinates": [ring]}}
    path.write_text(json.dumps({"features": [feature]}))


def test_bike_datasets(spark, tmp_path):
    root = str(tmp_path / "out")
    write_boundary(tmp_path / "boroughs.json")
    b.build_boundaries(spark, str(tmp_path / "boroughs.json"), "boro_code string", root, "boroughs")
    boundary = scan_layer(spark, root, "boroughs")
    write_info(tmp_path / "info.json.gz")
    b.build_stations(spark, str(tmp_path / "info.json.gz"), root, boundary)
    assert rows(scan_layer(spark, root, "station"), "station_id") == [("s",), ("t",)]

    write_captures(tmp_path / "captures", CAPTURES)
    b.build_status(spark, str(tmp_path / "captures"), root)
    assert scan_layer(spark, root, "status").count() == 6
    write_captures(tmp_path / "captures", {"2023-03-06_07:45:30": [station("s", SEVEN + 2700, 0, 9)]})
    b.build_status(spark, str(tmp_path / "captures"), root)
    assert scan_layer(spark, root, "status").count() == 7
    summary = scan_layer(spark, root, "status_summary").filter("period = 'all' AND station_id = 's'")
    assert summary.first().bikes_available_eq0 == 0.75 and summary.first().x is not None

    (tmp_path / "zips").mkdir()
    b.build_trips(spark, archives(tmp_path / "zips"), root, [2021])
    got = rows(scan_layer(spark, root, "trips_summary"), "station_id", "total_trips", "trips_per_dock")
    assert got == [("s", 4, 0), ("t", 5, None)]
    # loading the same archives again adds no station and no trip
    b.build_trips(spark, str(tmp_path / "zips" / "*.csv.zip"), root, [2021])
    assert scan_layer(spark, root, "trip_stations").count() == 5
    assert scan_layer(spark, root, "trips").count() == 6


def test_turnstile_dataset(spark, tmp_path):
    lines = [HEADER]
    for year in (2022, 2023):
        for day in (1, 2):
            for hour in (4, 8, 12):
                count = day * 100 + hour
                lines.append(f"A,R1,00,59 ST,N,BMT,03/0{day}/{year},{hour:02d}:00:00,REGULAR,{count},{2 * count}")
    (tmp_path / "turnstile_230304.txt").write_text("\n".join(lines) + "\n")
    (tmp_path / "lookup.csv").write_text("remote,booth,complex_id,station,line_name,division\nR1,A,7,59 ST,N,BMT\n")
    (tmp_path / "stations.csv").write_text(
        "Complex ID,GTFS Latitude,GTFS Longitude\n7,40.75,-73.99\n7,40.76,-73.98\n"
    )
    root = str(tmp_path / "out")
    layers = b.build_turnstiles(
        spark, str(tmp_path), str(tmp_path / "lookup.csv"), str(tmp_path / "stations.csv"),
        ["Complex ID", "GTFS Latitude", "GTFS Longitude"], root, [2022, 2023],
    )
    for layer in layers:
        assert scan_layer(spark, root, layer).columns
    wide = rows(
        scan_layer(spark, root, "annual_by_year"), "period", "complex_id", "total_entries_2022", "total_entries_all"
    )
    # first day: two steps of 4; second day: a step of 92 over 16 hours, then two of 4
    assert ("all", "7", 8 + 100, 2 * 108) in wide
    assert ("morning_peak", "7", 16 - 8, 16) in wide
    assert scan_layer(spark, root, "turnstile_observations").filter("year = 2022").count() == 6


def test_loads_add_up(spark, tmp_path):
    """A year, then a file that reaches back into it, then one of them again: every read once."""
    (tmp_path / "lookup.csv").write_text("remote,booth,complex_id,station,line_name,division\nR1,A,7,59 ST,N,BMT\n")
    (tmp_path / "stations.csv").write_text("Complex ID,GTFS Latitude,GTFS Longitude\n7,40.75,-73.99\n")
    root = str(tmp_path / "out")

    def file(name, *reads):
        lines = [HEADER] + [f"A,R1,00,59 ST,N,BMT,{day},{hour}:00:00,REGULAR,{n},{n}" for day, hour, n in reads]
        (tmp_path / name).write_text("\n".join(lines) + "\n")

    def load(start, end):
        b.build_turnstiles(
            spark, str(tmp_path), str(tmp_path / "lookup.csv"), str(tmp_path / "stations.csv"),
            ["Complex ID", "GTFS Latitude", "GTFS Longitude"], root, [2020, 2021], start, end,
        )
        total = scan_layer(spark, root, "annual_complex").filter("period = 'all'")
        return (
            rows(scan_layer(spark, root, "turnstile_observations"), "observed_at", "entries"),
            {r.year: r.total_entries for r in total.collect()},
        )

    file("turnstile_201226.txt", ("12/20/2020", "04", 10), ("12/20/2020", "08", 14), ("12/20/2020", "12", 20))
    file("turnstile_210102.txt", ("12/31/2020", "20", 500), ("01/01/2021", "00", 504), ("01/01/2021", "04", 510))
    seen, totals = load("2020-12-01", "2020-12-31")
    assert len(seen) == 3 and totals == {2020: 10}
    seen, totals = load("2021-01-01", "2021-12-31")
    # the read at midnight still belongs to the last service day of 2020
    assert len(seen) == 6 and totals == {2020: 14, 2021: 6}
    for again in (("2020-12-01", "2020-12-31"), (None, None)):
        assert load(*again) == (seen, totals)
    daily = scan_layer(spark, root, "daily_complex").filter("period = 'all'").agg({"entries": "sum"}).first()[0]
    assert daily == sum(totals.values())


def test_files_that_change_and_files_of_one_name(spark, tmp_path):
    """A file that grew replaces what was held of it; a second file of its name in another folder is another file."""
    (tmp_path / "lookup.csv").write_text("remote,booth,complex_id,station,line_name,division\nR1,A,7,59 ST,N,BMT\n")
    (tmp_path / "stations.csv").write_text("Complex ID,GTFS Latitude,GTFS Longitude\n7,40.75,-73.99\n")
    root = str(tmp_path / "out")

    def file(folder, name, *reads, unit="00"):
        (tmp_path / folder).mkdir(exist_ok=True)
        lines = [HEADER] + [f"A,R1,{unit},59 ST,N,BMT,{day},{hour}:00:00,REGULAR,{n},{n}" for day, hour, n in reads]
        (tmp_path / folder / name).write_text("\n".join(lines) + "\n")

    def load(folder):
        b.build_turnstiles(
            spark, str(tmp_path / folder), str(tmp_path / "lookup.csv"), str(tmp_path / "stations.csv"),
            ["Complex ID", "GTFS Latitude", "GTFS Longitude"], root, [2020, 2021],
        )
        return rows(scan_layer(spark, root, "turnstile_observations"), "unit_id", "observed_at", "entries")

    first = (("12/20/2020", "04", 10), ("12/20/2020", "08", 14))
    file("a", "turnstile_201226.txt", *first)
    file("a", "turnstile_210102.txt", ("01/01/2021", "04", 510))
    seen = load("a")
    assert [r[2] for r in seen] == [10, 14, 510] and load("a") == seen
    file("a", "turnstile_201226.txt", *first, ("12/20/2020", "12", 20))
    seen = load("a")
    assert [r[2] for r in seen] == [10, 14, 20, 510] and load("a") == seen
    file("b", "turnstile_201226.txt", *first, unit="01")
    seen = load("b")
    assert sorted(r[2] for r in seen) == [10, 10, 14, 14, 20, 510] and load("a") == load("b") == seen
    # the only file of 2021 now tells of 2020: the year goes with its rows
    file("a", "turnstile_210102.txt", ("12/31/2020", "04", 77))
    seen = load("a")
    assert sorted(r[2] for r in seen) == [10, 10, 14, 14, 20, 77]
    assert {r.year for r in scan_layer(spark, root, "turnstile_reads").select("year").collect()} == {2020}


def test_a_load_that_breaks_off_leaves_the_old_table(spark, tmp_path):
    """Rows that fail while they are made anew, after part of them was written aside: the layer is as before."""
    import pytest
    from pyspark.sql import functions as F

    from dockwise.sources.tables import load_by_source

    root = str(tmp_path)

    def given(version, values, breaks=False):
        df = spark.createDataFrame([("f", version, f"202{k}-01-01", v) for k, v in enumerate(values)], "source_file string, v string, t string, n long")
        df = df.withColumn("at", F.col("t").cast("timestamp_ntz")).drop("t").repartition(3)
        return df.withColumn("n", F.when(F.col("n") == 99, F.raise_error(F.lit("broken")).cast("long")).otherwise(F.col("n"))) if breaks else df

    def held():
        return rows(scan_layer(spark, root, "x"), "source_file", "v", "n", "year")

    load_by_source(given("1", [1, 2, 3]), root, "x", "at", version="v")
    before = held()
    with pytest.raises(Exception, match="broken"):
        load_by_source(given("2", [4, 99, 6], breaks=True), root, "x", "at", version="v")
    assert held() == before
    load_by_source(given("2", [4, 5, 6]), root, "x", "at", version="v")
    assert held() == [("f", "2", 4, 2020), ("f", "2", 5, 2021), ("f", "2", 6, 2022)]


def test_a_load_deals_no_rows_by_source(spark, tmp_path):
    """A layer far larger than a broadcast, of few sources: the rows to load meet the list where they lie."""
    from pyspark.sql import functions as F

    from dockwise.sources.tables import _unknown, load_by_source

    def given(*sources):
        df = spark.range(40_000).withColumn("at", F.expr("timestamp_ntz'2021-01-01 00:00:00'"))
        named = F.element_at(F.array(*map(F.lit, sources)), (F.col("id") % len(sources) + 1).cast("int"))
        return df.withColumn("source_file", named).withColumn("noise", F.rand(1))

    root, key = str(tmp_path), "spark.sql.autoBroadcastJoinThreshold"
    path = load_by_source(given("a", "b", None), root, "x", "at")
    old = spark.conf.get(key)
    spark.conf.set(key, "20KB")
    try:
        fresh = _unknown(given("b", "c", None), spark.read.parquet(path), "source_file")
        plan = fresh._jdf.queryExecution().executedPlan().toString()
        load_by_source(given("b", "c", None), root, "x", "at")
    finally:
        spark.conf.set(key, old)
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    counts = scan_layer(spark, root, "x").groupBy("source_file").count()
    assert rows(counts) == [(None, 13_333), ("a", 13_334), ("b", 13_333), ("c", 13_333)]


def test_unknown_stations_of_captures(spark, tmp_path):
    import pytest

    root = str(tmp_path / "out")
    write_boundary(tmp_path / "boroughs.json")
    b.build_boundaries(spark, str(tmp_path / "boroughs.json"), "boro_code string", root, "boroughs")
    write_info(tmp_path / "info.json.gz")
    b.build_stations(spark, str(tmp_path / "info.json.gz"), root, scan_layer(spark, root, "boroughs"))
    write_captures(tmp_path / "captures", {"2023-03-06_07:45:30": [station("s", SEVEN), station("far", SEVEN), station("x", SEVEN)]})
    with pytest.raises(ValueError, match="not in the station layer"):
        b.build_status(spark, str(tmp_path / "captures"), root, strict=True)
    b.build_status(spark, str(tmp_path / "captures"), root)
    assert rows(scan_layer(spark, root, "status_unknown")) == [("far", 1), ("x", 1)]
    assert scan_layer(spark, root, "status").count() == 3


def test_crashes_and_comments(spark, tmp_path):
    root = str(tmp_path / "out")
    write_boundary(tmp_path / "b.json")
    b.build_boundaries(spark, str(tmp_path / "b.json"), "boro_code string", root, "boroughs")

    def crash(lon, injured):
        return {"properties": {"crash_date": "2021-01-01T00:00:00.000", "number_of_cyclist_injured": injured,
                               "number_of_cyclist_killed": "0"}, "geometry": {"type": "Point", "coordinates": [lon, 40.75]}}

    (tmp_path / "c.json").write_text(json.dumps({"features": [crash(-73.99, "1"), crash(-73.99, "0"), crash(-75, "2")]}))
    b.build_crashes(spark, str(tmp_path / "c.json"), root, scan_layer(spark, root, "boroughs"))
    got = scan_layer(spark, root, "motor_vehicle_crashes").collect()
    assert [r.number_of_cyclist_injured for r in got] == [1.0] and 900_000 < got[0].x < 1_100_000

    page = ('<article class="approved-comment" id="c" data-comment-category-id="1" data-comment-lng="-74" '
            'data-comment-lat="40.16666666666667" data-comment-user-id="u"><p>here</p></article>')
    b.build_comments(spark.createDataFrame([(page,)], "html string"), root)
    comment = scan_layer(spark, root, "comments").first()
    assert abs(comment.x - 984250) < 1e-3 and comment.description == "here"

    street = {"properties": {"rw_type": "1"}, "geometry": {"type": "LineString", "coordinates": [[-74, 40.7], [-73.9, 40.8]]}}
    (tmp_path / "s.json").write_text(json.dumps({"features": [street]}))
    b.build_lines(spark, str(tmp_path / "s.json"), "rw_type string", root, "streets")
    assert scan_layer(spark, root, "streets").first().paths[0][0].x > 900_000


def test_population_cells(spark):
    region = g.Region(0.0, 0.0, 100.0, 20, 20)

    def square(name, people, x, y, side):
        corners = [(x, y), (x + side, y), (x + side, y + side), (x, y + side)]
        return (name, people, [[[{"x": float(a), "y": float(c)} for a, c in corners]]])

    schema = "tract string, population int, parts array<array<array<struct<x:double,y:double>>>>"
    tracts = spark.createDataFrame(
        [square("a", 600, 0, 0, 1000), square("sliver", 50, 1200, 0, 600)], schema
    )
    # the boundary takes the lower 6 rows: 60 cells of a, and 6 x 3 of the other
    boundary = region.cells(spark).filter("row < 6 AND col < 15")
    cells = s.population_cells(tracts, boundary, region)
    got = rows(cells, "value")
    assert got == [(10.0,)] * 60
    assert s.population_cells(tracts, boundary, region, min_area=100_000).count() == 78
