"""From raw files to named layers, one function per dataset.

Each function reads raw files, cleans them and writes layers under `root`; the
names it returns can be read with `scan_layer`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockwise.functions.geometry import project_parts, project_paths, project_points, state_plane
from dockwise.operators.clean import (
    filter_cyclist_crashes,
    prune_columns,
    reject_null_rows,
    text_to_number,
)
from dockwise.operators.grid import Region
from dockwise.operators.joins import anti_join_new, join_summary_geometry
from dockwise.operators.quality import check_domain, check_foreign_key, check_unique, require_none
from dockwise.operators.stations import incremental_captures
from dockwise.operators.trips import complete_trips, trips_summary_all, trips_summary_year
from dockwise.operators.trips import stations_of_trips
from dockwise.operators.vector import clip_points
from dockwise.plans.siting import siting_from_vectors
from dockwise.plans.status import status_summaries
from dockwise.plans.turnstile import annual_by_year, net_observations, turnstile_rollups
from dockwise.session import settle
from dockwise.sources import files
from dockwise.sources.schemas import CRASH_NUMBERS, CRASH_PROPERTIES, STATUS_FLAGS, STATUS_REQUIRED
from dockwise.sources.tables import append_rows, layer_exists, load_by_source, write_by_year, write_layer, write_raster

CLIP_TILE = 5000.0


def _exists(spark: SparkSession, root: str, layer: str) -> bool:
    return layer_exists(spark, f"{root}/{layer}")


def build_turnstiles(
    spark: SparkSession,
    raw: str,
    lookup: str,
    stations: str,
    station_columns: Sequence[str],
    root: str,
    years: Sequence[int],
    start=None,
    end=None,
) -> list[str]:
    """Turnstile files to reads by year, observations, daily, monthly, annual and multi-year tables.

    Reads are loaded by source file: files that were loaded before add nothing, those that
    have changed since are replaced, the others are added to what the years hold. Everything else is made from all stored reads, so the
    tables agree with them and with each other after any order of loads.
    """
    places = files.scan_transit_stations(spark, stations, station_columns)
    write_layer(places, root, "stations")
    reads = files.scan_turnstiles(spark, raw, start, end)
    versions = files.file_versions(spark, f"{raw}/{files.TURNSTILE_GLOB}").drop("path")
    reads = reads.join(versions, F.col("filename") == F.col("source_file"), "left")
    load_by_source(reads, root, "turnstile_reads", "observed_at", version="source_version")
    stored = files.scan_layer(spark, root, "turnstile_reads").drop("year", "source_file", "source_version")
    observations = net_observations(stored)
    write_by_year(observations, root, "turnstile_observations", "observed_at", whole=True)
    kept = files.scan_layer(spark, root, "turnstile_observations").drop("year")
    tables = turnstile_rollups(kept, files.scan_lookup(spark, lookup))
    for layer in ("daily_subunit", "daily_complex", "monthly_complex", "annual_complex"):
        write_layer(tables[layer], root, layer)
    annual = files.scan_layer(spark, root, "annual_complex")
    for period in ("all", "morning_peak", "evening_peak", "peak", "offpeak"):
        one = annual.filter(F.col("period") == period).drop("period")
        write_layer(annual_by_year(one, places, years), root, f"annual_by_year/period={period}")
    return [
        "stations",
        "turnstile_reads",
        "turnstile_observations",
        "daily_subunit",
        "daily_complex",
        "monthly_complex",
        "annual_complex",
        "annual_by_year",
    ]


def build_stations(
    spark: SparkSession, info: str, root: str, boundary: DataFrame | None = None
) -> list[str]:
    """Bike stations with a point, inside the boundary if one is given."""
    stations = files.scan_station_info(spark, info)
    if boundary is not None:
        stations = clip_points(stations, boundary, CLIP_TILE)
    stations = settle(stations)
    require_none(check_unique(stations, "station_id"), "a station stands twice")
    write_layer(stations, root, "station")
    return ["station"]


def build_status(
    spark: SparkSession, captures: str, root: str, zone: str = "America/New_York", strict: bool = False
) -> list[str]:
    """Captures newer than those loaded are appended, then all summaries are made anew.

    Stations of the new captures that the station layer lacks, for instance those outside
    its boundary, are listed in `status_unknown` with their rows; with `strict` they fail the load.
    """
    seen = files.scan_station_status(spark, captures, zone)
    rows = reject_null_rows(seen, STATUS_REQUIRED)
    if _exists(spark, root, "status"):
        rows = incremental_captures(rows, files.scan_layer(spark, root, "status"))
    rows = settle(rows)
    types = dict(rows.dtypes)
    for flag in STATUS_FLAGS:
        if types.get(flag) in ("int", "bigint"):  # a boolean holds nothing else
            outside = check_domain(rows, flag, (0, 1)).filter("violations > 0")
            require_none(outside, f"{flag} holds something else than 0 and 1")
    station = files.scan_layer(spark, root, "station")
    unknown = settle(check_foreign_key(rows, station, "station_id", "station_id"))
    if strict:
        require_none(unknown, "a station of the captures is not in the station layer")
    append_rows(rows, root, "status")
    write_layer(unknown, root, "status_unknown")
    status = files.scan_layer(spark, root, "status")
    summary = status_summaries(status, station, tie=("capture_datetime",))
    write_layer(join_summary_geometry(summary, station), root, "status_summary")
    return ["status", "status_unknown", "status_summary"]


def build_trips(
    spark: SparkSession, archives: str, root: str, years: Sequence[int]
) -> list[str]:
    """Trip archives to trips by year, their stations, and yearly and all-year summaries.

    The archives are unpacked once, into a table that everything else reads. Trips are
    loaded by source file: an archive that was loaded before adds nothing, one that has
    changed since is replaced, any other adds to what the years hold. Summaries are made from all stored trips.
    """
    versions = files.file_versions(spark, archives).select("path", "source_version")
    trips = files.scan_trips(spark, archives).join(versions, F.col("source_file") == F.col("path"), "left").drop("path")
    trips = settle(trips)
    seen = project_points(stations_of_trips(trips), "lng", "lat")
    if _exists(spark, root, "trip_stations"):
        seen = anti_join_new(seen, files.scan_layer(spark, root, "trip_stations"), "station_id")
    seen = settle(seen)
    require_none(check_unique(seen, "station_id"), "a station of the trips stands twice")
    append_rows(seen, root, "trip_stations")
    known = files.scan_layer(spark, root, "trip_stations")
    complete = complete_trips(trips, ["source_file", "source_version"])
    for end in ("start_station_id", "end_station_id"):
        require_none(check_foreign_key(complete, known, end, "station_id"), f"{end} of a trip is no station of the trips")
    load_by_source(complete, root, "trips", "started_at", version="source_version")
    kept = files.scan_layer(spark, root, "trips")
    station = files.scan_layer(spark, root, "station")
    yearly = trips_summary_year(kept, station, years)
    points = station.select("station_id", "x", "y")
    write_layer(yearly.join(points, "station_id"), root, "trips_summary_year")
    yearly = files.scan_layer(spark, root, "trips_summary_year")
    every = trips_summary_all(yearly, station.select("station_id", "capacity", "x", "y"))
    write_layer(every, root, "trips_summary")
    return ["trips", "trip_stations", "trips_summary_year", "trips_summary"]


def build_boundaries(spark: SparkSession, geojson: str, properties: str, root: str, layer: str) -> list[str]:
    """A polygon layer in state-plane feet."""
    polygons = files.scan_geojson(spark, geojson, properties, "polygon")
    write_layer(polygons.withColumn("parts", project_parts(F.col("parts"))), root, layer)
    return [layer]


def build_lines(spark: SparkSession, geojson: str, properties: str, root: str, layer: str) -> list[str]:
    """A line layer in state-plane feet."""
    lines = files.scan_geojson(spark, geojson, properties, "line")
    write_layer(lines.withColumn("paths", project_paths(F.col("paths"))), root, layer)
    return [layer]


def build_crashes(
    spark: SparkSession, geojson: str, root: str, boundary: DataFrame, since: str | None = None
) -> list[str]:
    """Crashes that hurt a cyclist, inside the boundary, in state-plane feet."""
    raw = files.scan_geojson(spark, geojson, CRASH_PROPERTIES, "point")
    names = [field.split()[0] for field in CRASH_PROPERTIES.split(", ")]
    numbers = text_to_number(prune_columns(raw, [*names, "x", "y"]), CRASH_NUMBERS)
    hurt = filter_cyclist_crashes(numbers) if since is None else filter_cyclist_crashes(numbers, since)
    x, y = state_plane(F.col("x"), F.col("y"))
    placed = hurt.withColumns({"x": x, "y": y})
    write_layer(clip_points(placed, boundary, CLIP_TILE), root, "motor_vehicle_crashes")
    return ["motor_vehicle_crashes"]


def build_tracts(spark: SparkSession, table: str, root: str, mercator: bool = True) -> list[str]:
    """Tracts with population, in state-plane feet."""
    tracts = files.scan_tract_population(spark, table)
    placed = tracts.withColumn("parts", project_parts(F.col("parts"), mercator))
    write_layer(placed, root, "acs")
    return ["acs"]


def build_comments(pages: DataFrame, root: str) -> list[str]:
    """Suggested places from pages of comments, in state-plane feet."""
    comments = files.scan_comments(pages)
    write_layer(project_points(comments), root, "comments")
    return ["comments"]


def build_siting(
    spark: SparkSession,
    root: str,
    fine: Region,
    medium: Region,
    weights: Mapping[str, float],
    wishes: Mapping[object, float] | None = None,
    wish_weight: float = 100,
    **options,
) -> list[str]:
    """Rasters of the siting model from the layers that the other builders wrote.

    Reads boroughs, streets, routes, acs, station, annual_by_year, motor_vehicle_crashes,
    status_summary and trips_summary; writes constraint, service_area, suitability and
    suitability_constrained, and both scores moved by `wishes` where there are any.
    """

    def layer(name: str, key: str | None = None) -> DataFrame:
        rows = files.scan_layer(spark, root, name)
        return rows if key is None else rows.withColumn("id", F.col(key))

    def numbered(name: str) -> DataFrame:
        rows = files.scan_layer(spark, root, name)
        return rows.withColumn("id", F.xxhash64(*rows.columns))

    status = layer("status_summary", "station_id")
    made = siting_from_vectors(
        boroughs=layer("boroughs"),
        streets=numbered("streets"),
        routes=numbered("routes"),
        tracts=numbered("acs"),
        docks=layer("station", "station_id"),
        complexes=layer("annual_by_year", "complex_id").filter("period = 'all'"),
        crashes=numbered("motor_vehicle_crashes"),
        peak=status.filter("period = 'peak'"),
        offpeak=status.filter("period = 'offpeak'"),
        trips=layer("trips_summary", "station_id"),
        fine=fine,
        medium=medium,
        weights=weights,
        wishes=wishes,
        wish_weight=wish_weight,
        **options,
    )
    for name, cells in made.items():
        write_raster(cells, f"{root}/{name}")
    return list(made)
