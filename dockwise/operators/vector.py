"""Lines and polygons on the grid, and points in polygons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dockwise.functions.geometry import edges, odd_crossings, segments
from dockwise.operators.grid import CELL, Region, cells_within
from dockwise.session import settle

EDGE = ("x1", "y1", "x2", "y2")


def _largest_key(cells: DataFrame) -> DataFrame:
    return cells.groupBy(*CELL).agg(F.max_by("_value", "_key").alias("value"))


def _span(first: Column, last: Column, limit: int) -> Column:
    low = F.greatest(first, F.lit(0)).cast("int")
    high = F.least(last, F.lit(limit - 1)).cast("int")
    return F.when(low <= high, F.sequence(low, high))


def rasterize_lines(
    lines: DataFrame, value: str | None, region: Region, key: str, paths: str = "paths"
) -> DataFrame:
    """Cells that lines touch; where several do, the line with the largest key counts.

    Each segment is cut at the grid rows it passes and fills the columns
    between the ends of each piece.
    """
    amount = F.lit(1.0) if value is None else F.col(value).cast("double")
    south, west, res = F.lit(region.south), F.lit(region.west), F.lit(region.res)
    parts = lines.select(
        F.col(key).alias("_key"),
        amount.alias("_value"),
        F.explode(segments(F.col(paths))).alias("_s"),
    ).select("_key", "_value", "_s.*")
    # in cell units, from the lower end to the upper one
    upward = F.col("y1") <= F.col("y2")

    def unit(a: str, b: str, start: Column) -> Column:
        return (F.when(upward, F.col(a)).otherwise(F.col(b)) - start) / res

    ends = parts.select(
        "_key",
        "_value",
        unit("x1", "x2", west).alias("xa"),
        unit("y1", "y2", south).alias("ya"),
        unit("x2", "x1", west).alias("xb"),
        unit("y2", "y1", south).alias("yb"),
    )
    rows = ends.withColumn(
        "row", F.explode(_span(F.floor("ya"), F.floor("yb"), region.rows))
    )

    def x_at(y: Column) -> Column:
        share = F.coalesce(F.try_divide(y - F.col("ya"), F.col("yb") - F.col("ya")), F.lit(0.0))
        return F.col("xa") + share * (F.col("xb") - F.col("xa"))

    flat = F.floor("ya") == F.floor("yb")
    first = F.when(flat, F.col("xa")).otherwise(x_at(F.greatest("ya", F.col("row").cast("double"))))
    last = F.when(flat, F.col("xb")).otherwise(
        x_at(F.least("yb", (F.col("row") + 1).cast("double")))
    )
    touched = rows.withColumns({"_a": F.least(first, last), "_b": F.greatest(first, last)})
    columns = F.explode(_span(F.floor("_a"), F.floor("_b"), region.cols))
    return _largest_key(touched.withColumn("col", columns))


def _numbered(polygons: DataFrame) -> DataFrame:
    """Distinct polygons under a number made from their content, the same on a re-run."""
    named = polygons.withColumn("_polygon", F.xxhash64(*polygons.columns))
    return named.dropDuplicates(["_polygon"])


def polygon_cells(
    polygons: DataFrame, region: Region, keep: list[str], parts: str = "parts"
) -> DataFrame:
    """One row per polygon and cell whose centre it holds (even-odd rule).

    Every edge meets the row centres it passes; along a row the meetings pair
    up into runs of columns. The work follows the edges and the filled cells,
    not the polygons' bounding boxes.
    """
    numbered = _numbered(polygons.select(*keep, parts))
    parted = numbered.select(
        "_polygon", *keep, F.explode(edges(F.col(parts))).alias("_e")
    ).select("_polygon", *keep, "_e.*")
    low = F.ceil((F.least("y1", "y2") - F.lit(region.south)) / F.lit(region.res) - 0.5)
    high = F.ceil((F.greatest("y1", "y2") - F.lit(region.south)) / F.lit(region.res) - 0.5) - 1
    met = parted.withColumn("row", F.explode(_span(low, high, region.rows)))
    y = region.y_of(F.col("row"))
    crossing = (y - F.col("y1")) * (F.col("x2") - F.col("x1")) / (
        F.col("y2") - F.col("y1")
    ) + F.col("x1")
    order = W.partitionBy("_polygon", "row").orderBy("_x", *EDGE)
    runs = (
        met.withColumn("_x", crossing)
        .withColumns({"_end": F.lead("_x").over(order), "_n": F.row_number().over(order)})
        .filter("_n % 2 = 1 AND _end IS NOT NULL")
    )

    def first_centre(x: str) -> Column:
        return F.ceil((F.col(x) - F.lit(region.west)) / F.lit(region.res) - 0.5)

    columns = F.explode(_span(first_centre("_x"), first_centre("_end") - 1, region.cols))
    return runs.withColumn("col", columns).select(*keep, *CELL)


def rasterize_polygons(
    polygons: DataFrame, value: str | None, region: Region, key: str, parts: str = "parts"
) -> DataFrame:
    """Attribute (or 1) of the polygon that holds each cell's centre; the largest key wins."""
    amount = F.lit(1.0) if value is None else F.col(value).cast("double")
    named = polygons.select(F.col(key).alias("_key"), amount.alias("_value"), parts)
    return _largest_key(polygon_cells(named, region, ["_key", "_value"], parts))


def polygon_tiles(polygons: DataFrame, side: float, parts: str = "parts") -> DataFrame:
    """Polygon edges by square map tile.

    A tile holds the edges that pass its band of y, anywhere from the tile to
    the polygon's east end: all that decides whether a point of the tile lies
    inside. A list is never longer than the polygon it comes from.
    """
    named = _numbered(polygons.select(parts))
    named = named.select("_polygon", F.explode(edges(F.col(parts))).alias("_e")).select(
        "_polygon", "_e.*"
    )

    def tile(v: Column) -> Column:
        return F.floor(v / F.lit(float(side))).cast("int")

    lowest, highest = F.least("y1", "y2"), F.greatest("y1", "y2")
    banded = named.withColumn("tile_y", F.explode(F.sequence(tile(lowest), tile(highest))))
    lists = banded.groupBy("_polygon", "tile_y").agg(
        F.collect_list(F.struct(*EDGE)).alias("edges"),
        F.min(F.least("x1", "x2")).alias("_west"),
        F.max(F.greatest("x1", "x2")).alias("_east"),
    )
    tiled = lists.withColumn(
        "tile_x", F.explode(F.sequence(tile(F.col("_west")), tile(F.col("_east"))))
    )
    start = F.col("tile_x") * F.lit(float(side))
    reaching = F.filter("edges", lambda e: F.greatest(e["x1"], e["x2"]) >= start)
    return tiled.select("tile_y", "tile_x", reaching.alias("edges"), "_west", "_east")


def clip_points(
    points: DataFrame,
    polygons: DataFrame,
    side: float,
    x: str = "x",
    y: str = "y",
    parts: str = "parts",
) -> DataFrame:
    """Points inside any polygon; points without a place go.

    Points meet only the polygons of their own tile, by an equality join.
    `side` should be near the width of a usual polygon. The tiled polygons are
    written first: the planner then broadcasts them by their real size, or
    shuffles and splits hot tiles when they are too big for that.
    """
    tiles = settle(polygon_tiles(polygons, side, parts))
    placed = points.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).withColumns(
        {
            "_ty": F.floor(F.col(y) / F.lit(float(side))).cast("int"),
            "_tx": F.floor(F.col(x) / F.lit(float(side))).cast("int"),
        }
    )
    same = (F.col("_ty") == F.col("tile_y")) & (F.col("_tx") == F.col("tile_x"))
    near = F.col(x).between(F.col("_west"), F.col("_east"))
    inside = odd_crossings(F.col(x), F.col(y), F.col("edges"))
    return placed.join(tiles, same & near & inside, "left_semi").drop("_ty", "_tx")


def clip_cells(
    cells: DataFrame, boundary: DataFrame, region: Region, key: str
) -> DataFrame:
    """Polygon cells inside a boundary: per key the number of cells left and their area."""
    inside = cells_within(cells, boundary)
    area = float(region.res) ** 2
    return inside.groupBy(key).agg(
        F.count(F.lit(1)).alias("cells"),
        (F.count(F.lit(1)) * F.lit(area)).alias("area"),
    )
