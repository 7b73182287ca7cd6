"""Scans and sinks: files that Spark writes from the tables, read back by the operators."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bindings.journeys import _layouts
from bindings.registry import bind, sql, table
from dockwise.functions.calendar import micros_between
from dockwise.operators import clean
from dockwise.operators.grid import Region, bin_sum
from dockwise.session import work_dir
from dockwise.sources import files, schemas, tables


def _csv(df: DataFrame, path: str) -> str:
    df.write.option("header", True).csv(path)
    return path


READS = """
    SELECT event_id, ts, 'A' || CAST(user_id AS VARCHAR) AS controlarea,
           'R' || CAST(user_id AS VARCHAR) AS remoteunit, '00-00-00' AS scp, event_type,
           CAST(floor(value) AS BIGINT) AS entries,
           CAST(json_extract_string(props, '$.k') AS BIGINT) AS exits FROM events
"""


def _turnstile_files(spark, sf) -> str:
    """Events as turnstile files, header and its blanks included."""
    events = table(spark, sf, "events")
    user = F.col("user_id").cast("string")
    raw = events.select(
        F.concat(F.lit("A"), user).alias("C/A"),
        F.concat(F.lit("R"), user).alias("UNIT"),
        F.lit("00-00-00").alias("SCP"),
        F.col("event_type").alias("STATION"),
        F.lit("X").alias("LINENAME"),
        F.lit("Y").alias("DIVISION"),
        F.date_format("ts", "MM/dd/yyyy").alias("DATE"),
        F.date_format("ts", "HH:mm:ss").alias("TIME"),
        F.lit("REGULAR").alias("DESC"),
        F.floor("value").cast("long").alias("ENTRIES"),
        F.get_json_object("props", "$.k").cast("long").alias("EXITS          "),
    )
    return _csv(raw, work_dir(spark, "turnstiles"))


@bind(
    "scan_turnstiles",
    f"""
    SELECT controlarea, remoteunit, scp AS subunit_channel_position, event_type AS station,
           'X' AS linenames, 'Y' AS division, strftime(ts, '%m/%d/%Y') AS date,
           strftime(ts, '%H:%M:%S') AS time, 'REGULAR' AS description, entries, exits,
           date_trunc('second', ts) AS observed_at,
           controlarea || remoteunit || scp AS unit_id,
           controlarea || remoteunit || scp || strftime(ts, '%Y%m%d%H%M%S') AS id
    FROM ({READS})
    """,
)
def scan_turnstiles(spark, sf):
    path = _turnstile_files(spark, sf)
    return files.scan_turnstiles(spark, path, glob="*.csv").drop("filename")


@bind(
    "scan_lookup",
    """
    SELECT CAST(c_custkey AS VARCHAR) AS remote, c_name AS booth,
           CASE WHEN c_mktsegment <> 'BUILDING' THEN CAST(c_nationkey AS VARCHAR) END AS complex_id,
           c_mktsegment AS station, 'A' AS line_name, 'B' AS division
    FROM customer
    """,
)
def scan_lookup(spark, sf):
    building = F.col("c_mktsegment") == "BUILDING"
    raw = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("remote"),
        F.col("c_name").alias("booth"),
        F.when(~building, F.col("c_nationkey").cast("string")).alias("complex_id"),
        F.col("c_mktsegment").alias("station"),
        F.lit("A").alias("line_name"),
        F.lit("B").alias("division"),
    )
    return files.scan_lookup(spark, _csv(raw, work_dir(spark, "lookup")))


# degrees near the state plane's origin, spread by balance and key
def _degrees(spark, sf):
    return table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias("id"),
        (F.lit(-74.3) + (F.col("s_acctbal") + 1000) / 20000).alias("lon"),
        (F.lit(40.4) + F.col("s_nationkey") * F.lit(0.02)).alias("lat"),
    )


# the conic projection in plain arithmetic, with constants worked out apart from the library
PROJECTED = """
    SELECT id, lon, lat,
           round((300000 + rho * sin(theta)) / (1200.0::DOUBLE / 3937), 3) AS x,
           round((rho0 - rho * cos(theta)) / (1200.0::DOUBLE / 3937), 3) AS y
    FROM (
        SELECT *, k.a * k.f * pow(t, k.n) AS rho, k.a * k.f * pow(k.t0, k.n) AS rho0,
               k.n * radians(lon + 74) AS theta
        FROM (
            SELECT id, lon, lat,
                   tan(pi() / 4 - radians(lat) / 2)
                   / pow((1 - e * sin(radians(lat))) / (1 + e * sin(radians(lat))), e / 2) AS t
            FROM degrees, ellipsoid), constants k)
"""
PROJECTION = """
    WITH degrees AS (
        SELECT CAST(s_suppkey AS VARCHAR) AS id,
               -74.3::DOUBLE + (s_acctbal + 1000) / 20000::DOUBLE AS lon,
               40.4::DOUBLE + s_nationkey * 0.02::DOUBLE AS lat
        FROM supplier),
    ellipsoid AS (
        SELECT sqrt(2 / 298.257222101::DOUBLE - pow(1 / 298.257222101::DOUBLE, 2)) AS e),
    parallels AS (
        SELECT i, cos(phi) / sqrt(1 - pow(e * sin(phi), 2)) AS m,
               tan(pi() / 4 - phi / 2) / pow((1 - e * sin(phi)) / (1 + e * sin(phi)), e / 2) AS t
        FROM ellipsoid, (VALUES (0, radians(40 + 10 / 60::DOUBLE)),
                                (1, radians(41 + 2 / 60::DOUBLE)),
                                (2, radians(40 + 40 / 60::DOUBLE))) v(i, phi)),
    exponent AS (
        SELECT (ln(p1.m) - ln(p2.m)) / (ln(p1.t) - ln(p2.t)) AS n
        FROM parallels p1, parallels p2 WHERE p1.i = 1 AND p2.i = 2),
    constants AS (
        SELECT 6378137::DOUBLE AS a, n, p1.m / (n * pow(p1.t, n)) AS f, p0.t AS t0
        FROM exponent, parallels p0, parallels p1 WHERE p0.i = 0 AND p1.i = 1)
"""


def _feet(df: DataFrame) -> DataFrame:
    return df.withColumns({"x": F.round("x", 3), "y": F.round("y", 3)})


@bind("project_points", PROJECTION + PROJECTED)
def project_points(spark, sf):
    return _feet(files.project_points(_degrees(spark, sf)))


@bind(
    "to_points",
    PROJECTION + "SELECT id, lon, lat, lon AS x, lat AS y FROM degrees",
)
def to_points(spark, sf):
    return files.to_points(_degrees(spark, sf), "lon", "lat")


@bind(
    "scan_transit_stations",
    PROJECTION
    + f"SELECT id AS complex_id, lon AS gtfs_longitude, lat AS gtfs_latitude, x, y FROM ({PROJECTED})",
)
def scan_transit_stations(spark, sf):
    raw = _degrees(spark, sf).toDF("Complex ID", "GTFS Longitude", "GTFS Latitude ")
    path = _csv(raw, work_dir(spark, "stations"))
    return _feet(files.scan_transit_stations(spark, path, raw.columns))


def _feed_batches(rows: DataFrame, number: str, *keys: str) -> DataFrame:
    """Station documents of at most 200 stations, `number` being unique."""
    batch = F.expr(f"{number} div 200").alias("_batch")
    feeds = rows.groupBy(*keys, batch).agg(F.collect_list("station").alias("stations"))
    return feeds.select(*keys, F.struct("stations").alias("data"))


@bind(
    "scan_station_info",
    PROJECTION
    + f"""
    SELECT id AS station_id, id || '-old' AS legacy_id, id || '-out' AS external_id, lon, lat,
           s_name AS name, id AS short_name, 'classic' AS station_type, s_nationkey AS capacity,
           false AS eightd_has_key_dispenser, s_nationkey % 2 = 0 AS rental_method_key,
           s_nationkey % 3 = 0 AS rental_method_credit, true AS has_kiosk,
           false AS electric_bike_surcharge_waiver,
           CASE WHEN s_acctbal > 0 THEN CAST(s_nationkey AS VARCHAR) END AS region_id, x, y
    FROM ({PROJECTED}) JOIN supplier ON id = CAST(s_suppkey AS VARCHAR)
    """,
)
def scan_station_info(spark, sf):
    degrees = _degrees(spark, sf)
    rows = table(spark, sf, "supplier").withColumn("id", F.col("s_suppkey").cast("string"))
    methods = F.array_compact(
        F.array(
            F.when(F.col("s_nationkey") % 2 == 0, "KEY"),
            F.when(F.col("s_nationkey") % 3 == 0, "CREDITCARD"),
            F.lit("APP"),
        )
    )
    record = F.struct(
        F.col("id").alias("station_id"),
        F.concat("id", F.lit("-old")).alias("legacy_id"),
        F.concat("id", F.lit("-out")).alias("external_id"),
        "lon",
        "lat",
        F.col("s_name").alias("name"),
        F.col("id").alias("short_name"),
        F.lit("classic").alias("station_type"),
        F.col("s_nationkey").alias("capacity"),
        F.lit(False).alias("eightd_has_key_dispenser"),
        methods.alias("rental_methods"),
        F.lit(True).alias("has_kiosk"),
        F.lit(False).alias("electric_bike_surcharge_waiver"),
        F.when(F.col("s_acctbal") > 0, F.col("s_nationkey").cast("string")).alias("region_id"),
    )
    feed = _feed_batches(
        rows.join(degrees, "id").select("s_suppkey", record.alias("station")), "s_suppkey"
    )
    path = work_dir(spark, "station-info")
    feed.select("data").write.option("maxRecordsPerFile", 1).option("compression", "gzip").json(path)
    return _feet(files.scan_station_info(spark, path).drop("objectid"))


def status_documents(spark, sf) -> DataFrame:
    """Events as status documents, with the day they stand for."""
    events = table(spark, sf, "events")
    bikes = F.floor("value").cast("int")
    valet = F.when(
        F.col("event_type") == "click",
        F.struct(
            F.lit("r1").alias("valet_revision"),
            F.lit(True).alias("active"),
            F.col("user_id").cast("int").alias("off_dock_count"),
            F.lit(9).alias("off_dock_capacity"),
            F.lit(0).alias("dock_blocked_count"),
        ),
    )
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    epoch = F.floor(micros_between(start, F.col("ts")) / 1_000_000)
    record = F.struct(
        F.col("event_id").cast("string").alias("station_id"),
        F.col("user_id").cast("string").alias("legacy_id"),
        F.lit(1).alias("is_installed"),
        F.lit(1).alias("is_renting"),
        F.lit(0).alias("is_returning"),
        bikes.alias("num_bikes_available"),
        F.lit(True).alias("eightd_has_available_keys"),
        F.array(F.lit("service")).alias("eightd_active_station_services"),
        F.col("event_type").alias("station_status"),
        epoch.alias("last_reported"),
        valet.alias("valet"),
    )
    rows = events.select("event_id", F.to_date("ts").alias("day"), record.alias("station"))
    return _feed_batches(rows, "event_id", "day")


def _named_captures(documents: DataFrame) -> DataFrame:
    return documents.withColumn(
        "capture", F.concat(F.date_format("day", "yyyy-MM-dd"), F.lit("_06-30-00"))
    )


STATUS_ROWS = """
    SELECT CAST(event_id AS VARCHAR) AS station_id, CAST(user_id AS VARCHAR) AS legacy_id,
           CAST(floor(value) AS INTEGER) AS num_bikes_available, event_type AS station_status,
           CASE WHEN event_type = 'click' THEN 'r1' END AS valet_revision,
           CASE WHEN event_type = 'click' THEN true END AS valet_active,
           CASE WHEN event_type = 'click' THEN CAST(user_id AS INTEGER) END AS valet_off_dock_count,
           CASE WHEN event_type = 'click' THEN 9 END AS valet_off_dock_capacity,
           date_trunc('day', ts) + INTERVAL 390 MINUTES AS capture_datetime,
           6 AS capture_hour, CAST(isodow(ts) - 1 AS INTEGER) AS capture_weekday,
           date_trunc('second', ts) - INTERVAL 5 HOURS AS reported_datetime,
           CAST(hour(ts - INTERVAL 5 HOURS) AS INTEGER) AS reported_hour,
           CAST(isodow(ts - INTERVAL 5 HOURS) - 1 AS INTEGER) AS reported_weekday
    FROM events
"""
STATUS_COLUMNS = [
    "station_id",
    "legacy_id",
    "num_bikes_available",
    "station_status",
    "valet_revision",
    "valet_active",
    "valet_off_dock_count",
    "valet_off_dock_capacity",
    "capture_datetime",
    "capture_hour",
    "capture_weekday",
    "reported_datetime",
    "reported_hour",
    "reported_weekday",
]


def capture_files(spark, sf) -> str:
    """Status documents as compressed files. Spark names the files itself, so the
    capture time stands in the directory: one per capture."""
    path = work_dir(spark, "captures")
    documents = _named_captures(status_documents(spark, sf))
    writer = documents.select("capture", "data").write.partitionBy("capture")
    writer.option("maxRecordsPerFile", 1).option("compression", "gzip").json(path)
    return path


@bind("scan_station_status", STATUS_ROWS)
def scan_station_status(spark, sf):
    rows = files.scan_station_status(spark, capture_files(spark, sf))
    return rows.select(*STATUS_COLUMNS)


@bind("flatten_status", STATUS_ROWS)
def flatten_status(spark, sf):
    documents = _named_captures(status_documents(spark, sf))
    texts = documents.select("capture", F.to_json(F.struct("data")).alias("text"))
    parsed = F.from_json("text", schemas.STATION_STATUS).alias("_d")
    feed = texts.select("capture", parsed).select("capture", "_d.data")
    return files.status_rows(feed, F.col("capture")).select(*STATUS_COLUMNS)


def trip_archives(spark, sf) -> DataFrame:
    """Line items as zipped trip files of both layouts, the items of 2000 orders to a file."""

    def zipped(rows: DataFrame) -> DataFrame:
        columns = [c for c in rows.columns if c != "l_orderkey"]

        def pack(part: pd.DataFrame) -> pd.DataFrame:
            held = io.BytesIO()
            with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as archive:
                archive.writestr("notes.txt", "x")
                archive.writestr("trips.csv", part[columns].to_csv(index=False))
            return pd.DataFrame({"content": [held.getvalue()]})

        return rows.groupBy(F.expr("l_orderkey div 2000")).applyInPandas(pack, "content binary")

    old, new = _layouts(spark, sf, "l_orderkey")
    return zipped(old).unionByName(zipped(new)).withColumn("path", F.lit("trips.zip"))


@bind("scan_trips", sql("SELECT * FROM harmonized"))
def scan_trips(spark, sf):
    return files.trips_from_archives(trip_archives(spark, sf)).drop("source_file")


CRASHES = """
    SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS crash_date,
           CASE WHEN event_type = 'purchase' THEN 1.0 ELSE 0.0 END::DOUBLE AS number_of_cyclist_killed,
           CAST(json_extract_string(props, '$.k') AS DOUBLE) AS number_of_cyclist_injured,
           round(value / 10, 4) AS x, -round(value / 10, 4) AS y
    FROM events
"""


def crash_documents(spark, sf) -> str:
    """Events as crash features, in collections of at most 200, one to a line."""
    place = F.round(F.col("value") / 10, 4)
    feature = F.struct(
        F.struct(
            F.col("event_id").cast("string").alias("zip_code"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("crash_date"),
            F.when(F.col("event_type") == "purchase", "1").otherwise("0").alias(
                "number_of_cyclist_killed"
            ),
            F.get_json_object("props", "$.k").alias("number_of_cyclist_injured"),
        ).alias("properties"),
        F.struct(F.lit("Point").alias("type"), F.array(place, -place).alias("coordinates")).alias(
            "geometry"
        ),
    )
    batch = F.expr("event_id div 200").alias("batch")
    rows = table(spark, sf, "events").select(batch, feature.alias("feature"))
    collections = rows.groupBy("batch").agg(F.collect_list("feature").alias("features"))
    path = work_dir(spark, "crashes")
    collections.select(F.lit("FeatureCollection").alias("type"), "features").write.json(path)
    return path


def _crashes(spark, sf) -> DataFrame:
    rows = files.scan_geojson(
        spark, crash_documents(spark, sf), schemas.CRASH_PROPERTIES, "point", multiline=False
    )
    kept = clean.prune_columns(
        rows,
        ["zip_code", "crash_date", "number_of_cyclist_killed", "number_of_cyclist_injured", "x", "y"],
    )
    counts = ("number_of_cyclist_killed", "number_of_cyclist_injured")
    numbers = clean.text_to_number(kept, {c: "double" for c in counts})
    return numbers.select(
        F.col("zip_code").cast("long").alias("event_id"), "crash_date", *counts, "x", "y"
    )


@bind("scan_geojson", CRASHES)
def scan_geojson(spark, sf):
    return _crashes(spark, sf)


@bind(
    "filter_cyclist_crashes",
    f"""
    SELECT * FROM ({CRASHES}) WHERE crash_date >= '2024-01-10T00:00:00.000'
      AND (number_of_cyclist_killed > 0 OR number_of_cyclist_injured > 0)
    """,
)
def filter_cyclist_crashes(spark, sf):
    return clean.filter_cyclist_crashes(_crashes(spark, sf), since="2024-01-10T00:00:00.000")


@bind(
    "text_to_number",
    """
    SELECT doc_id, TRY_CAST(trim(source) AS DOUBLE) AS source_number,
           TRY_CAST(CAST(n_chars AS VARCHAR) AS INTEGER) AS n_chars
    FROM documents
    """,
)
def text_to_number(spark, sf):
    rows = table(spark, sf, "documents").select(
        "doc_id", F.col("source").alias("source_number"), F.col("n_chars").cast("string").alias("n_chars")
    )
    return clean.text_to_number(rows, {"source_number": "double", "n_chars": "int"})


@bind("scan_tract_population", "SELECT c_custkey AS tract, c_acctbal AS population FROM customer")
def scan_tract_population(spark, sf):
    rows = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("tract"), F.col("c_acctbal").alias(schemas.POPULATION_VARIABLE)
    )
    root = work_dir(spark, "tracts")
    return files.scan_tract_population(spark, tables.write_layer(rows, root, "tracts"))


LINK = r"(?s)<a\b[^>]*>.*?</a>"


@bind(
    "scan_comments",
    r"""
    SELECT page_id, regexp_extract(element, '\shref="([^"]*)"', 1) AS link,
           regexp_replace(regexp_extract(element, '(?s)<a\b[^>]*>(.*?)</a>', 1), '<[^>]*>', '', 'g')
               AS description
    FROM (SELECT page_id, unnest(regexp_extract_all(html, '(?s)<a\b[^>]*>.*?</a>')) AS element
          FROM pages)
    """,
)
def scan_comments(spark, sf):
    return files.scan_comments(
        table(spark, sf, "pages"),
        block=LINK,
        attributes={"link": "href"},
        body=r"(?s)<a\b[^>]*>(.*?)</a>",
        keep=["page_id"],
    )


# --- layers ---


def _customers(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal")


CUSTOMERS = "SELECT c_custkey, c_nationkey, c_acctbal FROM customer"


@bind("write_layer", CUSTOMERS)
def write_layer(spark, sf):
    return spark.read.parquet(tables.write_layer(_customers(spark, sf), work_dir(spark, "w"), "c"))


@bind("scan_layer", CUSTOMERS)
def scan_layer(spark, sf):
    root = work_dir(spark, "layers")
    tables.write_layer(_customers(spark, sf), root, "customers")
    return files.scan_layer(spark, root, "customers")


@bind("create_table_as", CUSTOMERS + " WHERE c_acctbal > 0")
def create_table_as(spark, sf):
    rows, root = _customers(spark, sf), work_dir(spark, "as")
    tables.create_table_as(rows, root, "c")
    return spark.read.parquet(tables.create_table_as(rows.filter("c_acctbal > 0"), root, "c"))


@bind("create_table_if_absent", CUSTOMERS)
def create_table_if_absent(spark, sf):
    rows, root = _customers(spark, sf), work_dir(spark, "absent")
    tables.create_table_if_absent(rows, root, "c")
    return spark.read.parquet(
        tables.create_table_if_absent(rows.filter("c_acctbal > 0"), root, "c")
    )


@bind("append_rows", f"{CUSTOMERS} UNION ALL {CUSTOMERS} WHERE c_acctbal > 0")
def append_rows(spark, sf):
    rows, root = _customers(spark, sf), work_dir(spark, "append")
    tables.append_rows(rows, root, "c")
    return spark.read.parquet(tables.append_rows(rows.filter("c_acctbal > 0"), root, "c"))


@bind(
    "write_by_year",
    "SELECT o_orderkey, o_orderdate, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders",
)
def write_by_year(spark, sf):
    rows, root = table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), work_dir(spark, "y")
    tables.write_by_year(rows, root, "orders", "o_orderdate")
    # a year written again replaces that year alone
    again = rows.filter(F.year("o_orderdate") == 1997)
    return spark.read.parquet(tables.write_by_year(again, root, "orders", "o_orderdate"))


@bind(
    "load_by_source",
    """
    SELECT l_orderkey, l_linenumber, l_shipdate, 'part' || CAST(l_orderkey % 4 AS VARCHAR) AS source_file,
           CAST(year(l_shipdate) AS INTEGER) AS year
    FROM lineitem
    """,
)
def load_by_source(spark, sf):
    """Line items in four parts that all reach over all years, loaded in overlapping pairs."""
    part = F.concat(F.lit("part"), (F.col("l_orderkey") % 4).cast("string"))
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", part.alias("source_file"))
    root = work_dir(spark, "sources")
    for parts in (["part0", "part1"], ["part1", "part2"], ["part0", "part1", "part2", "part3"], ["part3"]):
        some = rows.filter(F.col("source_file").isin(parts))
        path = tables.load_by_source(some, root, "lineitem", "l_shipdate")
    return spark.read.parquet(path)


@bind(
    "append_named_result",
    "SELECT 'rich' AS result, * FROM (" + CUSTOMERS + " WHERE c_acctbal > 0) UNION ALL "
    "SELECT 'poor' AS result, * FROM (" + CUSTOMERS + " WHERE c_acctbal <= 0)",
)
def append_named_result(spark, sf):
    rows, root = _customers(spark, sf), work_dir(spark, "named")
    tables.append_named_result(rows.filter("c_acctbal > 0"), root, "c", "rich")
    path = tables.append_named_result(rows.filter("c_acctbal <= 0"), root, "c", "poor")
    return spark.read.parquet(path)


BALANCES = Region(-1000.0, 0.0, 100.0, 25, 110)
BALANCE_CELLS = """
    SELECT CAST(least(floor(CAST(c_nationkey * 100 AS DOUBLE) / 100), 24) AS INTEGER) AS row,
           CAST(least(floor((c_acctbal + 1000) / 100), 109) AS INTEGER) AS col,
           CAST(count(*) AS DOUBLE) AS value
    FROM customer GROUP BY ALL
"""


def _balance_cells(spark, sf):
    points = table(spark, sf, "customer").select(
        F.col("c_acctbal").alias("x"), (F.col("c_nationkey") * 100.0).alias("y")
    )
    return bin_sum(points, None, BALANCES)


@bind("write_raster", BALANCE_CELLS)
def write_raster(spark, sf):
    path = tables.write_raster(_balance_cells(spark, sf), work_dir(spark, "raster"), band=4)
    return spark.read.parquet(path).drop("band")


@bind("scan_raster", BALANCE_CELLS)
def scan_raster(spark, sf):
    path = tables.write_raster(_balance_cells(spark, sf), work_dir(spark, "raster"))
    return files.scan_raster(spark, path)


# --- columns and files by name ---


@bind(
    "normalize_headers",
    "SELECT c_custkey AS customer_key, c_name AS full_name, c_acctbal AS account_balance FROM customer",
)
def normalize_headers(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    return clean.normalize_headers(rows.toDF(" Customer Key", "Full Name ", "ACCOUNT BALANCE"))


@bind("rename_columns", "SELECT n_nationkey AS remote, n_name AS station, n_regionkey FROM nation")
def rename_columns(spark, sf):
    return clean.rename_columns(
        table(spark, sf, "nation"), {"n_nationkey": "remote", "n_name": "station", "absent": "x"}
    )


@bind("prune_columns", "SELECT p_partkey, p_size FROM part")
def prune_columns(spark, sf):
    return clean.prune_columns(table(spark, sf, "part"), ["p_partkey", "absent", "p_size"])


@bind("parse_observed_at", "SELECT event_id, date_trunc('second', ts) AS observed_at FROM events")
def parse_observed_at(spark, sf):
    rows = table(spark, sf, "events").select(
        "event_id",
        F.date_format("ts", "MM/dd/yyyy").alias("date"),
        F.date_format("ts", "HH:mm:ss").alias("time"),
    )
    return clean.parse_observed_at(rows).select("event_id", "observed_at")


@bind(
    "unit_keys",
    """
    SELECT event_id, u AS unit_id, u || strftime(ts, '%Y%m%d%H%M%S') AS id
    FROM (SELECT event_id, ts, CAST(user_id AS VARCHAR) || event_type || props AS u FROM events)
    """,
)
def unit_keys(spark, sf):
    rows = table(spark, sf, "events").withColumn("user", F.col("user_id").cast("string"))
    return clean.unit_keys(rows, ["user", "event_type", "props"], "ts").select(
        "event_id", "unit_id", "id"
    )


@bind(
    "membership_flags",
    """
    SELECT conv_id, turn, list_contains(string_split(text, ' '), 'the') AS has_the,
           list_contains(string_split(text, ' '), 'de') AS has_de FROM conversations
    """,
)
def membership_flags(spark, sf):
    rows = table(spark, sf, "conversations").select(
        "conv_id", "turn", F.split("text", " ").alias("words")
    )
    return clean.membership_flags(rows, "words", {"the": "has_the", "de": "has_de"}).drop("words")


@bind("optional_field", "SELECT r_regionkey, r_name, CAST(NULL AS VARCHAR) AS region_id FROM region")
def optional_field(spark, sf):
    rows = clean.optional_field(table(spark, sf, "region"), "region_id")
    return clean.optional_field(rows, "r_name")


@bind(
    "population_per_cell",
    """
    SELECT p_partkey, 10000.0::DOUBLE AS cell_area,
           p_retailprice * 10000.0::DOUBLE / (p_size * 1000.0::DOUBLE) AS pop_per_area FROM part
    """,
)
def population_per_cell(spark, sf):
    rows = table(spark, sf, "part").select(
        "p_partkey",
        F.col("p_retailprice").alias("population"),
        (F.col("p_size") * 1000.0).alias("area"),
    )
    return clean.population_per_cell(rows, 10000).drop("population", "area")


@bind(
    "fix_capacity_typo",
    """
    SELECT l_orderkey, l_linenumber, l_partkey,
           CASE WHEN l_quantity > 20 THEN l_quantity / 10 ELSE l_quantity END
               AS trips_per_day_per_dock
    FROM lineitem
    """,
)
def fix_capacity_typo(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").alias("trips_per_day_per_dock")
    )
    return clean.fix_capacity_typo(rows)


@bind("filter_slivers", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 278784")
def filter_slivers(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return clean.filter_slivers(rows, "o_totalprice")


@bind("filter_category", "SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey = 3")
def filter_category(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return clean.filter_category(rows, "c_nationkey", 3)


@bind(
    "filter_files_by_date",
    """
    SELECT o_orderkey, 'turnstile_' || strftime(o_orderdate, '%y%m%d') || '.txt' AS name,
           CAST(o_orderdate AS DATE) AS file_date
    FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-12-31'
    """,
)
def filter_files_by_date(spark, sf):
    stamp = F.date_format("o_orderdate", "yyMMdd")
    rows = table(spark, sf, "orders").select(
        "o_orderkey", F.concat(F.lit("turnstile_"), stamp, F.lit(".txt")).alias("name")
    )
    return clean.filter_files_by_date(rows, "1997-01-01", "1997-12-31")


@bind(
    "period_file_range",
    """
    SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year,
           CAST(month(o_orderdate) AS INTEGER) AS month
    FROM orders WHERE year(o_orderdate) * 100 + month(o_orderdate) BETWEEN 199611 AND 199802
    """,
)
def period_file_range(spark, sf):
    rows = table(spark, sf, "orders").select(
        "o_orderkey", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")
    )
    return clean.period_file_range(rows, (1996, 11), (1998, 2))
