"""Geometry as plain columns.

A point is two doubles. A line is `paths`: array of arrays of {x, y}. A polygon
is `parts`: array of polygons, each an array of rings (the first one outer, the
rest holes), each ring an array of {x, y}, closed or not.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

POINT = "struct<x:double,y:double>"
PATHS = f"array<array<{POINT}>>"
PARTS = f"array<array<array<{POINT}>>>"

# New York Long Island state plane (EPSG 2263), GRS 80 ellipsoid,
# Lambert conformal conic with two standard parallels, US survey feet.
SEMI_MAJOR = 6378137.0
INVERSE_FLATTENING = 298.257222101
FOOT = 1200.0 / 3937.0
PARALLELS = (41.0 + 2.0 / 60.0, 40.0 + 40.0 / 60.0)
ORIGIN = (-74.0, 40.0 + 10.0 / 60.0)
FALSE_EASTING = 300000.0

_FLATTENING = 1.0 / INVERSE_FLATTENING
_ECCENTRICITY = math.sqrt(2.0 * _FLATTENING - _FLATTENING**2)


def _cone(latitude: float) -> tuple[float, float]:
    """Parallel radius factor and conformal co-latitude at a fixed latitude."""
    phi = math.radians(latitude)
    e_sin = _ECCENTRICITY * math.sin(phi)
    m = math.cos(phi) / math.sqrt(1.0 - e_sin**2)
    t = math.tan(math.pi / 4 - phi / 2) / ((1 - e_sin) / (1 + e_sin)) ** (_ECCENTRICITY / 2)
    return m, t


_M1, _T1 = _cone(PARALLELS[0])
_M2, _T2 = _cone(PARALLELS[1])
_, _T0 = _cone(ORIGIN[1])
_N = (math.log(_M1) - math.log(_M2)) / (math.log(_T1) - math.log(_T2))
_SCALE = SEMI_MAJOR * _M1 / (_N * _T1**_N)
_RHO0 = _SCALE * _T0**_N


def state_plane(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Longitude and latitude in degrees to state-plane feet, in closed form."""
    phi = F.radians(lat)
    e_sin = F.lit(_ECCENTRICITY) * F.sin(phi)
    t = F.tan(F.lit(math.pi / 4) - phi / 2) / F.pow(
        (1 - e_sin) / (1 + e_sin), F.lit(_ECCENTRICITY / 2)
    )
    rho = F.lit(_SCALE) * F.pow(t, F.lit(_N))
    theta = F.lit(_N) * (F.radians(lon) - F.lit(math.radians(ORIGIN[0])))
    x = (F.lit(FALSE_EASTING) + rho * F.sin(theta)) / F.lit(FOOT)
    y = (F.lit(_RHO0) - rho * F.cos(theta)) / F.lit(FOOT)
    return x, y


def web_mercator_to_degrees(x: Column, y: Column) -> tuple[Column, Column]:
    """Spherical mercator metres (EPSG 3857) to longitude and latitude."""
    lon = F.degrees(x / F.lit(SEMI_MAJOR))
    lat = F.degrees(2 * F.atan(F.exp(y / F.lit(SEMI_MAJOR))) - F.lit(math.pi / 2))
    return lon, lat


def to_points(df: DataFrame, lon: str, lat: str, x: str = "x", y: str = "y") -> DataFrame:
    """Point columns from coordinate columns, still in degrees."""
    return df.withColumns({x: F.col(lon).cast("double"), y: F.col(lat).cast("double")})


def project_points(
    df: DataFrame, lon: str = "lon", lat: str = "lat", x: str = "x", y: str = "y"
) -> DataFrame:
    """State-plane point columns from degrees."""
    px, py = state_plane(F.col(lon).cast("double"), F.col(lat).cast("double"))
    return df.withColumns({x: px, y: py})


def project_parts(parts: Column, mercator: bool = False) -> Column:
    """The same projection over every vertex of a polygon column."""

    def vertex(p: Column) -> Column:
        lon, lat = p["x"], p["y"]
        if mercator:
            lon, lat = web_mercator_to_degrees(lon, lat)
        x, y = state_plane(lon, lat)
        return F.struct(x.alias("x"), y.alias("y"))

    return F.transform(
        parts, lambda rings: F.transform(rings, lambda ring: F.transform(ring, vertex))
    )


def project_paths(paths: Column) -> Column:
    """The same projection over every vertex of a line column."""

    def vertex(p: Column) -> Column:
        x, y = state_plane(p["x"], p["y"])
        return F.struct(x.alias("x"), y.alias("y"))

    return F.transform(paths, lambda path: F.transform(path, vertex))


def path_segments(path: Column, closed: bool = False) -> Column:
    """Consecutive vertex pairs of a path; a closed one also joins its ends."""
    first = F.slice(path, F.lit(1), F.greatest(F.size(path) - 1, F.lit(0)))
    second = F.slice(path, F.lit(2), F.greatest(F.size(path) - 1, F.lit(0)))
    pairs = F.arrays_zip(first.alias("a"), second.alias("b"))
    if closed:
        ends = F.array(
            F.struct(F.element_at(path, -1).alias("a"), F.element_at(path, 1).alias("b"))
        )
        pairs = F.concat(pairs, ends)
    return F.transform(
        pairs,
        lambda s: F.struct(
            s["a"]["x"].alias("x1"),
            s["a"]["y"].alias("y1"),
            s["b"]["x"].alias("x2"),
            s["b"]["y"].alias("y2"),
        ),
    )


def edges(parts: Column) -> Column:
    """Every edge of every ring of a polygon column."""
    rings = F.filter(F.flatten(parts), lambda ring: F.size(ring) > 0)
    return F.flatten(F.transform(rings, lambda ring: path_segments(ring, closed=True)))


def segments(paths: Column) -> Column:
    """Every segment of a line column."""
    return F.flatten(F.transform(paths, lambda path: path_segments(path)))


def ring_area(ring: Column) -> Column:
    """Unsigned shoelace area of one ring."""
    twice = F.aggregate(
        path_segments(ring, closed=True),
        F.lit(0.0),
        lambda total, e: total + (e["x1"] * e["y2"] - e["x2"] * e["y1"]),
    )
    return F.abs(twice) / 2


def polygon_area(rings: Column) -> Column:
    """Area of one polygon: its outer ring less its holes."""
    outer = F.try_element_at(rings, F.lit(1))
    holes = F.slice(rings, F.lit(2), F.greatest(F.size(rings) - 1, F.lit(0)))
    return ring_area(outer) - F.aggregate(
        holes, F.lit(0.0), lambda total, hole: total + ring_area(hole)
    )


def parts_area(parts: Column) -> Column:
    """Area of a polygon column with any number of parts."""
    return F.aggregate(parts, F.lit(0.0), lambda total, rings: total + polygon_area(rings))


def odd_crossings(x: Column, y: Column, edge_list: Column) -> Column:
    """Whether an odd number of edges lies to the right of a point."""
    crossings = F.filter(
        edge_list,
        lambda e: ((e["y1"] > y) != (e["y2"] > y))
        & (x < (y - e["y1"]) * (e["x2"] - e["x1"]) / (e["y2"] - e["y1"]) + e["x1"]),
    )
    return F.size(crossings) % 2 == 1
