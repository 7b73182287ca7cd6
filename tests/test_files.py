"""Raw files of every kind, written by hand."""

import datetime as dt
import json

from conftest import rows

from dockwise.functions.geometry import parts_area, project_parts, web_mercator_to_degrees
from dockwise.operators import clean
from dockwise.operators import quality as q
from dockwise.sources import files, schemas, tables
from pyspark.sql import functions as F

HEADER = "C/A,UNIT,SCP,STATION,LINENAME,DIVISION,DATE,TIME,DESC,ENTRIES,EXITS                      "


def test_turnstiles(spark, tmp_path):
    (tmp_path / "turnstile_230304.txt").write_text(
        f"{HEADER}\nA002,R051,02-00-00,59 ST,NQR456W,BMT,03/04/2023,00:00:00,REGULAR,0007,0000003   \n"
        "A002,R051,02-00-00,,NQR456W,BMT,03/04/2023,04:00:00,REGULAR,8,4\n"
    )
    (tmp_path / "notes.txt").write_text("other")
    reads = files.scan_turnstiles(spark, str(tmp_path))
    got = reads.orderBy("observed_at").collect()
    assert len(got) == 2
    assert got[0].unit_id == "A002R05102-00-00"
    assert got[0].id == "A002R05102-00-0020230304000000"
    assert (got[0].entries, got[0].exits) == (7, 3)
    assert got[0].observed_at == dt.datetime(2023, 3, 4)
    assert got[0].filename.endswith("turnstile_230304.txt")
    (tmp_path / "turnstile_230311.txt").write_text(
        f"{HEADER}\nA002,R051,02-00-00,59 ST,NQR456W,BMT,03/11/2023,00:00:00,REGULAR,9,5\n"
    )
    later = files.scan_turnstiles(spark, str(tmp_path), start=dt.date(2023, 3, 5))
    assert [r.entries for r in later.collect()] == [9]
    assert files.scan_turnstiles(spark, str(tmp_path), end=dt.date(2023, 3, 11)).count() == 3
    # no station name: the row is rejected
    kept = clean.reject_null_rows(reads, schemas.TURNSTILE_REQUIRED)
    assert [r.entries for r in kept.collect()] == [7]
    nulls = {r.column: r.nulls for r in q.check_not_null(reads, schemas.TURNSTILE_REQUIRED).collect()}
    assert {c for c, n in nulls.items() if n} == {"station"}


def test_lookup(spark, tmp_path):
    path = tmp_path / "lookup.csv"
    path.write_text("remote,booth,complex_id,station,line_name,division\nR001,A060,0635,WHITEHALL ST,R1,BMT\nR9,B1,,X,Y,Z\n")
    assert rows(files.scan_lookup(spark, str(path)), "remote", "complex_id") == [("R001", "0635"), ("R9", None)]


def test_transit_stations(spark, tmp_path):
    path = tmp_path / "stations.csv"
    path.write_text("Station ID,Complex ID,GTFS Latitude,GTFS Longitude\n1,01,40.16666666666667,-74\n")
    got = files.scan_transit_stations(
        spark, str(path), ["Station ID", "Complex ID", "GTFS Latitude", "GTFS Longitude"]
    ).first()
    assert got.complex_id == "01"
    assert abs(got.x - 984250.0) < 1e-3 and abs(got.y) < 1e-3


def test_geojson(spark, tmp_path):
    square = [[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]
    hole = [[0.5, 0.5], [0.5, 1.5], [1.5, 1.5], [1.5, 0.5], [0.5, 0.5]]
    features = [
        {"properties": {"boro_code": "1"}, "geometry": {"type": "Polygon", "coordinates": [square, hole]}},
        {"properties": {"boro_code": "2"}, "geometry": {"type": "MultiPolygon", "coordinates": [[square], [[[5, 5], [6, 5], [6, 6]]]]}},
        {"properties": {}, "geometry": None},
    ]
    path = tmp_path / "boroughs.json"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": features}, indent=1))
    polygons = files.scan_geojson(spark, str(path), "boro_code string", "polygon")
    got = polygons.select("boro_code", parts_area(F.col("parts")))
    assert rows(got) == [(None, None), ("1", 3.0), ("2", 4.5)]
    lines = [
        {"properties": {"rw_type": "1"}, "geometry": {"type": "LineString", "coordinates": [[0, 0], [1, 1]]}},
        {"properties": {"rw_type": "x"}, "geometry": {"type": "MultiLineString", "coordinates": [[[0, 0], [1, 0]], [[2, 2], [3, 3]]]}},
    ]
    path = tmp_path / "streets.json"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": lines}))
    streets = files.scan_geojson(spark, str(path), "rw_type string", "line")
    assert rows(streets.select("rw_type", F.size("paths"))) == [("1", 1), ("x", 2)]
    assert rows(clean.text_to_number(streets, {"rw_type": "int"}), "rw_type") == [(None,), (1,)]


def test_crashes(spark, tmp_path):
    def crash(date, killed, injured, point):
        geometry = point and {"type": "Point", "coordinates": point}
        return {"properties": {"crash_date": date, "number_of_cyclist_killed": killed,
                               "number_of_cyclist_injured": injured, "other": 1}, "geometry": geometry}

    features = [
        crash("2018-12-31T00:00:00.000", "1", "0", [1, 1]),
        crash("2019-01-01T00:00:00.000", "0", "1", [1, 1]),
        crash("2020-01-01T00:00:00.000", "0", "0", [1, 1]),
        crash("2020-01-01T00:00:00.000", "1", "n/a", None),
    ]
    path = tmp_path / "crashes.json"
    path.write_text(json.dumps({"features": features}))
    raw = files.scan_geojson(spark, str(path), schemas.CRASH_PROPERTIES, "point")
    numbers = clean.text_to_number(raw, schemas.CRASH_NUMBERS)
    kept = clean.filter_cyclist_crashes(numbers)
    assert rows(kept, "crash_date", "number_of_cyclist_injured", "x") == [
        ("2019-01-01T00:00:00.000", 1.0, 1.0), ("2020-01-01T00:00:00.000", None, None),
    ]


def test_comments(spark):
    page = (
        '<div><article id="c1" class="x approved-comment" data-comment-category-id="4" data-comment-lng="-73.9" '
        'data-comment-lat="40.7" data-comment-user-id="u" data-comment-locsumm="5 Av &amp; 1 St">\n'
        "<h2>t</h2><p>Please <b>here</b>\nA &lt; B</p></article>"
        '<article class="approved-comment" id="c2" data-comment-category-id="4" data-comment-lng="" '
        'data-comment-lat="40.7" data-comment-user-id="v"><p>x</p></article>'
        '<article class="other" id="c3"><p>y</p></article></div>'
    )
    got = files.scan_comments(spark.createDataFrame([(page,)], "html string"))
    assert rows(got, "id", "lon", "lat", "location", "description") == [
        ("c1", -73.9, 40.7, "5 Av & 1 St", "Please here\nA < B"), ("c2", None, None, None, "x"),
    ]


def test_tracts(spark, tmp_path):
    """Tracts come in mercator metres; the area is in square feet."""
    side = 20037508.342789244 / 180 / 100  # a hundredth of a degree of longitude
    x, y = -74 * 111319.49079327358, 4970241.327215  # 74 W, about 40.7 N
    corners = [(x, y), (x + side, y), (x + side, y + side), (x, y + side)]
    ring = F.array(*[F.struct(F.lit(a).alias("x"), F.lit(b).alias("y")) for a, b in corners])
    raw = spark.range(1).select(F.array(F.array(ring)).alias("parts"), F.lit(900).alias(schemas.POPULATION_VARIABLE))
    tables.write_layer(raw, str(tmp_path), "acs")
    tracts = files.scan_tract_population(spark, str(tmp_path / "acs"))
    feet = tracts.withColumn("area", parts_area(project_parts(F.col("parts"), mercator=True)))
    area = feet.first().area
    lon, lat = (c for c in web_mercator_to_degrees(F.lit(x), F.lit(y)))
    degrees = spark.range(1).select(lon.alias("lon"), lat.alias("lat")).first()
    assert abs(degrees.lon + 74) < 1e-9 and abs(degrees.lat - 40.7) < 0.05
    # ground metres shrink with the cosine of the latitude, squared for an area
    import math

    expected = (side * math.cos(math.radians(degrees.lat)) / 0.3048006096) ** 2
    assert abs(area / expected - 1) < 0.01
    assert clean.filter_slivers(feet).count() == 1
    held = clean.population_per_cell(feet, 10_000).first()
    assert abs(held.pop_per_area - 900 * 10_000 / area) < 1e-9


def test_file_dates(spark):
    names = spark.createDataFrame(
        [("turnstile_190101.txt",), ("turnstile_191228.txt",), ("turnstile_200104.txt",), ("readme",)], "name string"
    )
    inside = clean.filter_files_by_date(names, dt.date(2019, 1, 1), dt.date(2019, 12, 28))
    assert rows(inside, "name") == [("turnstile_190101.txt",), ("turnstile_191228.txt",)]
    assert clean.filter_files_by_date(names, start=dt.date(2019, 12, 1)).count() == 2
    assert clean.filter_files_by_date(names).count() == 3


def test_month_range(spark):
    months = spark.range(2017, 2022).selectExpr("cast(id as int) year", "explode(sequence(1, 12)) month")
    kept = clean.period_file_range(months, (2018, 11), (2020, 2))
    assert kept.count() == 2 + 12 + 2


def test_year_partitions_prune(spark, tmp_path):
    reads = spark.sql("SELECT timestamp_ntz'2019-05-05' t, 1 n UNION ALL SELECT timestamp_ntz'2020-05-05', 2")
    path = tables.write_by_year(reads, str(tmp_path), "trips", "t")
    plan = spark.read.parquet(path).filter("year = 2020")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    replaced = spark.sql("SELECT timestamp_ntz'2020-01-01' t, 9 n")
    tables.write_by_year(replaced, str(tmp_path), "trips", "t")
    assert rows(spark.read.parquet(path), "n", "year") == [(1, 2019), (9, 2020)]


def test_row_limit(spark):
    assert rows(q.check_row_limit(spark.range(5), 5)) == [(5, True)]
    assert rows(q.check_row_limit(spark.range(5), 6)) == [(5, False)]


def test_domain_lets_nulls_pass(spark):
    flags = spark.createDataFrame([(0,), (1,), (2,), (None,)], "stale int")
    assert rows(q.check_domain(flags, "stale", [0, 1])) == [(4, 1)]


def test_escapes(spark):
    given = "a &amp;amp; b&#8217;s caf&eacute; &#x1F600;&#xe9;&unknown;&#0; &lt;p&gt; &copy; 2 &middot; &#39; & ;&"
    got = spark.createDataFrame([(given,), (None,), ("",)], "t string").select(files.unescape(F.col("t"))).collect()
    assert got[0][0] == "a &amp; b’s café \U0001f600é&unknown;&#0; <p> © 2 · ' & ;&"
    assert (got[1][0], got[2][0]) == (None, "")


def test_all_named_escapes(spark):
    """Every name of the standard's table that ends in a semicolon, as the standard library resolves it."""
    import html
    from html.entities import html5

    given = [(f"a&{name}b &amp;{name} &{name}{name}",) for name in html5 if name.endswith(";")]
    assert len(given) == 2125
    got = spark.createDataFrame(given, "t string").select("t", files.unescape(F.col("t")).alias("u")).collect()
    assert all(r["u"] == html.unescape(r["t"]) for r in got)


def test_archives_are_read_once(spark):
    """One pass over the archives gives both layouts."""
    empty = spark.createDataFrame([], "path string, content binary")
    plan = files.trips_from_archives(empty)._jdf.queryExecution().analyzed().toString()
    assert plan.count("MapInPandas") == 1


def test_loaded_captures_are_not_opened(spark, tmp_path):
    """The bound of an incremental load prunes the list of files."""
    from dockwise.operators.stations import incremental_captures
    from test_status import CAPTURES, write_captures

    write_captures(tmp_path, CAPTURES)
    seen = files.scan_station_status(spark, str(tmp_path))
    newest = max(r[0] for r in seen.select("capture_datetime").distinct().collect())
    loaded = seen.filter(F.col("capture_datetime") < newest)
    fresh = incremental_captures(seen, loaded)
    opened = {r[0] for r in fresh.select("capture_datetime").distinct().collect()}
    assert opened == {newest}
    parts = fresh._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in parts or fresh.rdd.getNumPartitions() <= seen.rdd.getNumPartitions()
