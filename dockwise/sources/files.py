"""Scans of the raw feeds."""

from __future__ import annotations

import io
import itertools
import json
from collections.abc import Iterable, Iterator, Sequence
from html.entities import html5

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockwise.functions.calendar import calendar_parts
from dockwise.functions.geometry import PATHS, project_points, to_points
from dockwise.operators.clean import (
    dated_between,
    membership_flags,
    normalize_headers,
    parse_observed_at,
    rename_columns,
    unit_keys,
)
from dockwise.operators.stations import flatten_status, report_time
from dockwise.operators.trips import harmonize_mixed
from dockwise.sources.ranges import (
    LINE_TYPES,
    RANGE_BYTES,
    cells_of,
    feature_rows,
    known,
    listed,
    splittable,
    table_lines,
    zipped_lines,
)
from dockwise.sources.schemas import (
    LOOKUP,
    NEW_TRIP_FILE,
    OLD_TRIP_FILE,
    POPULATION_VARIABLE,
    RENTAL_FLAGS,
    STATION_INFO,
    STATION_STATUS,
    TURNSTILE_RAW,
)

TURNSTILE_GLOB = "turnstile_*.txt"
#: Capture files are named after a time of day, which holds colons. The checksumming local
#: file system cannot open such names; these options read local files without checksums.
LOCAL_COLONS = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


def turnstile_raw(spark: SparkSession, path: str) -> DataFrame:
    """Turnstile files as they are; the header is skipped, the columns come in fixed order."""
    types = ", ".join(
        f"`{c}` {'long' if c in ('ENTRIES', 'EXITS') else 'string'}" for c in TURNSTILE_RAW
    )
    return (
        spark.read.schema(types)
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .csv(path)
    )


def scan_turnstiles(
    spark: SparkSession, path: str, start=None, end=None, glob: str = TURNSTILE_GLOB
) -> DataFrame:
    """Turnstile reads under a directory, renamed, keyed and with the path of their file.

    With `start` or `end` only files dated within are opened, both inclusive.
    """
    raw = turnstile_raw(spark, f"{path}/{glob}")
    if start is not None or end is not None:
        raw = raw.filter(dated_between(F.col("_metadata.file_name"), start, end))
    named = raw.withColumn("filename", F.col("_metadata.file_path"))
    return unit_keys(parse_observed_at(rename_columns(named, TURNSTILE_RAW)))


def file_versions(spark: SparkSession, glob: str) -> DataFrame:
    """Rows (path, source_file, source_version) of the files under a path; nothing of them is read.

    source_file is the whole path, as text, so files of one name in two folders are two;
    source_version holds size and time of change.
    """
    listing = spark.read.format("binaryFile").load(glob)
    stamp = F.unix_micros("_metadata.file_modification_time")
    return listing.select(
        "path",
        F.col("_metadata.file_path").alias("source_file"),
        F.concat_ws(":", F.col("_metadata.file_size"), stamp).alias("source_version"),
    )


def scan_lookup(spark: SparkSession, path: str) -> DataFrame:
    """Remote to complex table; ids stay text, blanks are null."""
    return spark.read.schema(LOOKUP).option("header", True).option("nullValue", "").csv(path)


def scan_transit_stations(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Subway stations with tidy headers and a state-plane point.

    `columns` are the file's headers; all come as text but the two coordinates.
    """
    types = ", ".join(f"`{c}` string" for c in columns)
    raw = spark.read.schema(types).option("header", True).option("nullValue", "").csv(path)
    tidy = normalize_headers(raw)
    degrees = to_points(tidy, "gtfs_longitude", "gtfs_latitude", "gtfs_longitude", "gtfs_latitude")
    return project_points(degrees, "gtfs_longitude", "gtfs_latitude")


def scan_station_info(spark: SparkSession, path: str) -> DataFrame:
    """Bike stations, one row per entry of the feed, with a state-plane point."""
    feed = spark.read.schema(STATION_INFO).option("multiLine", True).json(path)
    rows = feed.select(F.posexplode("data.stations").alias("objectid", "_s"))
    flat = membership_flags(rows.select("objectid", "_s.*"), "rental_methods", RENTAL_FLAGS)
    return project_points(flat.drop("rental_methods"))


def capture_time(path: Column) -> Column:
    """Capture time from the 19 characters a file name begins with, `-` allowed for `:`.

    A directory so named serves too, for captures kept as one directory each.
    """
    named = F.regexp_extract(path, r"(\d{4}-\d\d-\d\d_\d\d[:-]\d\d[:-]\d\d)[^/]*(/[^/]*)?$", 1)
    text = F.nullif(named, F.lit(""))
    return F.to_timestamp_ntz(F.translate(text, ":", "-"), F.lit("yyyy-MM-dd_HH-mm-ss"))


def capture_path() -> Column:
    """Path of the file a row comes from, its escapes resolved."""
    return F.url_decode("_metadata.file_path")


def status_rows(feed: DataFrame, file_name: Column, zone: str = "America/New_York") -> DataFrame:
    """Station rows of status documents, with capture and report time in parts."""
    rows = feed.select(
        capture_time(file_name).alias("_captured"), F.explode("data.stations").alias("_s")
    ).select("_captured", "_s.*")
    timed = calendar_parts(rows, "_captured", "capture").withColumn(
        "_reported", report_time(F.col("last_reported"), zone)
    )
    parts = calendar_parts(timed, "_reported", "reported")
    return flatten_status(parts).drop("_captured", "_reported", "last_reported")


def scan_station_status(
    spark: SparkSession, path: str, zone: str = "America/New_York"
) -> DataFrame:
    """Status captures under a directory; file names may hold colons."""
    feed = spark.read.schema(STATION_STATUS).option("multiLine", True).options(**LOCAL_COLONS).json(path)
    return status_rows(feed.withColumn("_file", capture_path()), F.col("_file"), zone)


def unzip_largest(archives: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of the largest member of each zip (`path`, `content`), as text columns after `path`.

    Absent columns are null, as are the texts that stand for no value.
    """
    columns = list(columns)

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                lines = table_lines(io.BytesIO(content), columns)
                while part := list(itertools.islice(lines, 20_000)):
                    places, texts = zip(*part)
                    yield pd.DataFrame({"path": [path] * len(part), "places": places, "line": texts}, dtype=object)

    return cells_of(archives.select("path", "content").mapInPandas(unpack, LINE_TYPES), columns)


def _harmonised(both: DataFrame) -> DataFrame:
    return harmonize_mixed(both.withColumnRenamed("path", "source_file"), ["source_file"])


def trips_from_archives(archives: DataFrame) -> DataFrame:
    """Harmonised trips of zipped trip files of both layouts, in one pass, with `source_file`."""
    return _harmonised(unzip_largest(archives, [*OLD_TRIP_FILE, *NEW_TRIP_FILE]))


def scan_trips(spark: SparkSession, glob: str) -> DataFrame:
    """Zipped trip files, harmonised. Write the result once and read that from then on.

    Every archive is a partition; its directory names the member, whose lines are streamed,
    so a task needs the same memory for an archive of any size. Where the file system is
    none that Python knows, the archives come through Spark's own reader, whole.
    """
    found = listed(spark, glob)
    wanted = [*OLD_TRIP_FILE, *NEW_TRIP_FILE]
    if all(known(path) for path, _ in found):
        return _harmonised(cells_of(zipped_lines(spark, found, wanted), wanted))
    return trips_from_archives(spark.read.format("binaryFile").load(glob))


def scan_geojson(
    spark: SparkSession,
    path: str,
    properties: str,
    geometry: str = "point",
    multiline: bool = True,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """Features of FeatureCollections: the properties and one geometry column.

    `geometry` is point (x, y), line (paths) or polygon (parts); a missing
    geometry is null. A file is one collection and is read in ranges of bytes, by several
    tasks where it is large; compressed files, and those of a file system that only Spark
    knows, are read whole. With `multiline=False` every line of a file is a collection of its own.
    """
    feature = f"struct<properties: struct<{_colons(properties)}>, geometry: struct<type: string, coordinates: string>>"
    found = listed(spark, path) if multiline else []
    if multiline and splittable(found):
        # parsed as the JSON reader parses: a feature that is none has no properties and no geometry
        features = feature_rows(spark, found, range_bytes).select(F.from_json("feature", feature).alias("_f"))
    else:
        feed = spark.read.schema(f"features array<{feature}>").option("multiLine", multiline).json(path)
        features = feed.select(F.explode("features").alias("_f"))
    rows = features.select(
        "_f.properties.*",
        F.col("_f.geometry.type").alias("_type"),
        F.col("_f.geometry.coordinates").alias("_text"),
    )
    return with_geometry(rows, geometry).drop("_type", "_text")


def _colons(properties: str) -> str:
    fields = [field.strip().split(" ") for field in properties.split(",")]
    return ", ".join(f"{name}: {dtype}" for name, dtype in fields)


def with_geometry(rows: DataFrame, geometry: str) -> DataFrame:
    """Geometry columns from GeoJSON type (`_type`) and coordinate text (`_text`)."""
    text, kind = F.col("_text"), F.col("_type")
    pair = "array<double>"

    def vertices(path: Column) -> Column:
        return F.transform(path, lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))

    def rings(polygon: Column) -> Column:
        return F.transform(polygon, vertices)

    if geometry == "point":
        point = F.from_json(text, pair)
        return rows.withColumns({"x": point[0], "y": point[1]})
    if geometry == "line":
        single = F.array(vertices(F.from_json(text, f"array<{pair}>")))
        several = rings(F.from_json(text, f"array<array<{pair}>>"))
        paths = F.when(kind == "LineString", single).when(kind == "MultiLineString", several)
        return rows.withColumn("paths", paths.cast(PATHS))
    single = F.array(rings(F.from_json(text, f"array<array<{pair}>>")))
    several = F.transform(F.from_json(text, f"array<array<array<{pair}>>>"), rings)
    parts = F.when(kind == "Polygon", single).when(kind == "MultiPolygon", several)
    return rows.withColumn("parts", parts)


def scan_tract_population(spark: SparkSession, path: str) -> DataFrame:
    """Exported tract table with the population variable under its plain name."""
    tracts = spark.read.parquet(path)
    return tracts.withColumnRenamed(POPULATION_VARIABLE, "population")


def scan_layer(spark: SparkSession, root: str, layer: str) -> DataFrame:
    """A named layer."""
    return spark.read.parquet(f"{root}/{layer}")


def scan_raster(spark: SparkSession, path: str) -> DataFrame:
    """A saved raster as cells."""
    return spark.read.parquet(path).select("row", "col", "value")


#: Escapes that make up most of what pages hold; they are looked up first.
COMMON = "lt gt amp quot apos nbsp copy reg deg middot laquo raquo ndash mdash lsquo rsquo ldquo rdquo bull hellip".split()
#: Named escapes and their characters, as the HTML standard lists them; those that need no semicolon are there with one too.
ESCAPES = {name[:-1]: characters for name, characters in html5.items() if name.endswith(";")}
ESCAPE = r"&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"


def _character(escape: Column) -> Column:
    """The character of an escape such as `#8217`, `#x2019` or `rsquo`; null if it is unknown."""
    number = F.when(
        escape.rlike("^#[xX]"), F.conv(F.substring(escape, 3, 6), 16, 10)
    ).otherwise(F.substring(escape, 2, 7)).try_cast("int")
    point = F.when((number > 0) & (number < 0x110000) & ~number.between(0xD800, 0xDFFF), number)
    byte = [
        F.when(point < 0x80, F.hex(point)),
        F.when(point < 0x800, F.hex(0xC080 + F.shiftleft(F.shiftright(point, 6), 8) + (point % 64))),
        F.when(
            point < 0x10000,
            F.hex(0xE08080 + F.shiftleft(F.shiftright(point, 12), 16)
                  + F.shiftleft(F.shiftright(point, 6) % 64, 8) + (point % 64)),
        ),
        F.hex(F.lit(0xF0808080) + F.shiftleft(F.shiftright(point, 18).cast("long"), 24)
              + F.shiftleft(F.shiftright(point, 12) % 64, 16)
              + F.shiftleft(F.shiftright(point, 6) % 64, 8) + (point % 64)),
    ]
    numeric = F.decode(F.unhex(F.coalesce(*byte)), "UTF-8")
    return F.when(escape.startswith("#"), numeric).otherwise(F.coalesce(_named(COMMON, escape), _named(ESCAPES, escape)))


def _named(names: Iterable[str], escape: Column) -> Column:
    # a text that the optimizer turns into one constant map, and not into thousands of literals
    return F.from_json(F.lit(json.dumps({name: ESCAPES[name] for name in names})), "map<string,string>")[escape]


def unescape(text: Column) -> Column:
    """Text with its character escapes resolved, each once: decimal, hexadecimal and named.

    An escape that names no character stays as it is.
    """
    return F.when(F.contains(text, F.lit("&")), _resolved(text)).otherwise(text)


def _resolved(text: Column) -> Column:
    escapes = F.regexp_extract_all(text, F.lit(ESCAPE), F.lit(1))
    between = F.split(text, ESCAPE, -1)
    characters = F.transform(
        escapes, lambda e: F.coalesce(_character(e), F.concat(F.lit("&"), e, F.lit(";")))
    )
    pairs = F.transform(
        between, lambda part, i: F.concat(part, F.coalesce(F.get(characters, i), F.lit("")))
    )
    return F.array_join(pairs, "")


def _attribute(name: str, tag: str = "_tag") -> Column:
    found = F.regexp_extract(tag, rf'\s{name}="([^"]*)"', 1)
    return F.when(F.col(tag).rlike(rf'\s{name}="'), unescape(found))


# How a comment is marked up.
COMMENT_BLOCK = r'(?s)<article\b[^>]*\bclass="[^"]*\bapproved-comment\b[^"]*"[^>]*>.*?</article>'
COMMENT_ATTRIBUTES = {
    "id": "id",
    "category_id": "data-comment-category-id",
    "lon": "data-comment-lng",
    "lat": "data-comment-lat",
    "user": "data-comment-user-id",
    "location": "data-comment-locsumm",
}


def scan_comments(
    pages: DataFrame,
    html: str = "html",
    block: str = COMMENT_BLOCK,
    attributes: dict[str, str] | None = None,
    body: str = r"(?s)<p\b[^>]*>(.*?)</p>",
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per comment element of each page.

    A missing attribute is null. Blank or broken coordinates make both null.
    """
    attributes = COMMENT_ATTRIBUTES if attributes is None else attributes
    found = F.regexp_extract_all(F.col(html), F.lit(block), F.lit(0))
    elements = pages.select(*keep, F.explode(found).alias("_element"))
    tagged = elements.withColumn("_tag", F.regexp_extract("_element", r"^<[^>]*>", 0))
    inner = F.regexp_replace(F.regexp_extract("_element", body, 1), r"<[^>]*>", "")
    rows = tagged.withColumns(
        {name: _attribute(attribute) for name, attribute in attributes.items()}
    ).withColumn("description", unescape(inner))
    if "lon" in attributes and "lat" in attributes:
        lon, lat = (F.trim(c).try_cast("double") for c in ("lon", "lat"))
        both = lon.isNotNull() & lat.isNotNull()
        rows = rows.withColumns({"lon": F.when(both, lon), "lat": F.when(both, lat)})
    return rows.drop("_element", "_tag")
