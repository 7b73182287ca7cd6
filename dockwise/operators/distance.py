"""Distance to, and value of, the nearest filled cell.

Unbounded questions use the separable exact transform: the nearest source
within each column by two window passes, then along each row the lower
envelope of one parabola per column. A task holds one grid row at a time,
whose size the region fixes. Questions that end at a maximum distance only
look at the tiles around the sources and never build the rest of the grid.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dockwise.operators.grid import CELL, Region, halo_tiles, located, tile_side


def nearest_on_line(at: np.ndarray, cost: np.ndarray, width: int, scale: int = 1) -> np.ndarray:
    """For each x in 0..width-1 the index minimising scale * (x - at)^2 + cost.

    `at` ascends. All arithmetic is whole-numbered, hence exact.
    """
    lifted = (cost + scale * at * at).tolist()
    places = at.tolist()
    kept: list[int] = []
    starts: list[int] = []
    for j, place in enumerate(places):
        start = 0
        while kept:
            i = kept[-1]
            # first x from which j beats i
            start = (lifted[j] - lifted[i]) // (2 * scale * (place - places[i])) + 1
            if start > starts[-1]:
                break
            kept.pop()
            starts.pop()
        if not kept:
            start = 0
        if start < width:
            kept.append(j)
            starts.append(start)
    return np.asarray(kept)[np.searchsorted(starts, np.arange(width), side="right") - 1]


def _column_nearest(sources: DataFrame, region: Region, carried: list[str]) -> DataFrame:
    """Per cell the nearest source of its own column: squared rows away, and what it carries."""
    held = F.struct(F.col("row").alias("at"), *carried)
    marked = sources.select(*CELL, held.alias("_source"))
    blank = region.cells(sources.sparkSession)
    everything = blank.unionByName(marked, allowMissingColumns=True)
    up = W.partitionBy("col").orderBy("row")
    down = W.partitionBy("col").orderBy(F.col("row").desc())
    seen = everything.withColumns(
        {
            "_below": F.last("_source", ignorenulls=True).over(up),
            "_above": F.last("_source", ignorenulls=True).over(down),
        }
    ).filter(F.col("_source").isNull())

    def candidate(side: str) -> Column:
        gap = (F.col("row") - F.col(f"{side}.at")).cast("long")
        rest = [F.col(f"{side}.{c}").alias(c) for c in carried]
        return F.when(
            F.col(side).isNotNull(), F.struct((gap * gap).alias("d2"), *rest)
        )

    best = F.least(candidate("_below"), candidate("_above"))
    return seen.select(*CELL, best.alias("_best")).filter("_best IS NOT NULL").select(
        *CELL, "_best.*"
    )


def distance_to_nearest(
    cells: DataFrame, region: Region, max_dist: float | None = None
) -> DataFrame:
    """Euclidean distance in map units from each cell to the nearest filled one.

    With `max_dist` only the cells within that distance are returned.
    """
    sources = cells.filter(F.col("value").isNotNull()).select(*CELL)
    if max_dist is not None:
        return _distance_in_band(sources, region, max_dist)
    width, res = region.cols, float(region.res)

    def along_row(key: tuple, line: pd.DataFrame) -> pd.DataFrame:
        line = line.sort_values("col")
        at = line["col"].to_numpy(dtype="int64")
        cost = line["d2"].to_numpy(dtype="int64")
        best = nearest_on_line(at, cost, width)
        x = np.arange(width)
        squared = (x - at[best]) ** 2 + cost[best]
        return pd.DataFrame(
            {
                "row": np.full(width, key[0], dtype="int32"),
                "col": x.astype("int32"),
                "value": np.sqrt(squared.astype("float64")) * res,
            }
        )

    columns = _column_nearest(sources.distinct(), region, [])
    return columns.groupBy("row").applyInPandas(along_row, "row int, col int, value double")


def _distance_in_band(sources: DataFrame, region: Region, max_dist: float) -> DataFrame:
    res = float(region.res)
    reach = int(max_dist // res)
    side = tile_side(region, reach, 256)
    width = side + 2 * reach
    rows, cols = region.rows, region.cols
    far = width + reach + 1
    # squares of what is within reach fit the narrow type in all but vast bands
    kind = "int32" if reach < 30_000 else "int64"

    def in_tile(key: tuple, tile: pd.DataFrame) -> pd.DataFrame:
        top, left = key[0] * side, key[1] * side
        filled = np.zeros((width, width), dtype=bool)
        filled[
            tile["row"].to_numpy() - top + reach, tile["col"].to_numpy() - left + reach
        ] = True
        # rows to the nearest filled cell of the same column, above and below
        index = np.arange(width, dtype=kind)[:, None]
        edge = np.array([-far, width + far], dtype=kind)
        below = np.maximum.accumulate(np.where(filled, index, edge[0]), axis=0)
        above = np.minimum.accumulate(np.where(filled, index, edge[1])[::-1], axis=0)[::-1]
        gap = np.minimum(index - below, above - index)[reach : reach + side]
        gap = np.minimum(gap, reach + 1).astype(kind)
        vertical = gap * gap
        squared = np.full((side, side), np.iinfo(kind).max, dtype=kind)
        for dx in range(-reach, reach + 1):
            shifted = vertical[:, reach + dx : reach + dx + side] + np.array(dx * dx, dtype=kind)
            np.minimum(squared, shifted, out=squared)
        distance = np.sqrt(squared.astype("float64")) * res
        row, col = np.nonzero(distance <= max_dist)
        inside = (row + top < rows) & (col + left < cols)
        row, col = row[inside], col[inside]
        return pd.DataFrame(
            {
                "row": (row + top).astype("int32"),
                "col": (col + left).astype("int32"),
                "value": distance[row, col],
            }
        )

    tiles = halo_tiles(sources.distinct(), region, side, reach).groupBy("tile_row", "tile_col")
    return tiles.applyInPandas(in_tile, "row int, col int, value double")


def nearest_values(
    points: DataFrame,
    values: Sequence[str],
    region: Region,
    key: str,
    x: str = "x",
    y: str = "y",
    side: int = 64,
) -> DataFrame:
    """Values of the point nearest to each cell's centre; of equally near ones, the smallest key.

    Distances are those of the points' own coordinates. The transform of the occupied
    cells bounds how far a tile of cells has to look: the nearest point lies no farther
    than the nearest occupied cell and a cell's diagonal. So every tile meets the points
    of the tiles within its bound, and no others. Points of one place count once, the
    smallest key standing for them.
    """
    if not values:
        raise ValueError("at least one value is needed")
    names = [f"_value{i}" for i in range(len(values))]
    placed = located(points, region, x, y).select(
        *CELL,
        F.col(x).cast("double").alias("_x"),
        F.col(y).cast("double").alias("_y"),
        F.col(key).alias("_key"),
        *[F.col(v).cast("double").alias(n) for v, n in zip(values, names)],
    )
    best = F.min(F.struct("_key", *names)).alias("_best")
    placed = placed.groupBy(*CELL, "_x", "_y").agg(best).select(*CELL, "_x", "_y", "_best.*")
    side = tile_side(region, 1, side)
    res, diagonal = float(region.res), 2**0.5 * float(region.res)

    bound = distance_to_nearest(placed.select(*CELL, F.lit(1.0).alias("value")), region)
    tiles = bound.groupBy(
        F.expr(f"row div {side}").cast("int").alias("tile_row"), F.expr(f"col div {side}").cast("int").alias("tile_col")
    ).agg((F.max("value") + diagonal).alias("_bound"))
    reach = F.ceil(F.col("_bound") / (res * side)).cast("int")

    def around(tile: str, count: int) -> Column:
        last = (count - 1) // side
        return F.sequence(F.greatest(F.col(tile) - reach, F.lit(0)), F.least(F.col(tile) + reach, F.lit(last)))

    wide = tiles.withColumn("_from_row", F.explode(around("tile_row", region.rows)))
    wide = wide.withColumn("_from_col", F.explode(around("tile_col", region.cols)))
    # cells between two tiles, 0 for neighbours
    gaps = [F.greatest(F.abs(F.col(f"_from_{c}") - F.col(f"tile_{c}")) - 1, F.lit(0)) for c in ("row", "col")]
    apart = F.sqrt(gaps[0] * gaps[0] + gaps[1] * gaps[1]) * F.lit(res * side)
    wide = wide.filter(apart <= F.col("_bound")).drop("_bound")
    sources = placed.withColumns(
        {"_from_row": F.expr(f"row div {side}").cast("int"), "_from_col": F.expr(f"col div {side}").cast("int")}
    ).drop(*CELL)
    met = sources.join(wide, ["_from_row", "_from_col"])
    rows, cols, west, south = region.rows, region.cols, float(region.west), float(region.south)

    def in_tile(tile: tuple, found: pd.DataFrame) -> pd.DataFrame:
        found = found.sort_values("_key", kind="stable")
        px, py = found["_x"].to_numpy(), found["_y"].to_numpy()
        row = np.arange(tile[0] * side, min(rows, (tile[0] + 1) * side))
        col = np.arange(tile[1] * side, min(cols, (tile[1] + 1) * side))
        cx, cy = west + (col + 0.5) * res, south + (row + 0.5) * res
        least = np.full((len(row), len(col)), np.inf)
        which = np.zeros((len(row), len(col)), dtype=np.int64)
        for at in range(0, len(px), 256):  # a bounded table of squares at a time
            dx, dy = cx[:, None] - px[None, at : at + 256], cy[:, None] - py[None, at : at + 256]
            squares = (dx * dx)[None, :, :] + (dy * dy)[:, None, :]
            nearest = squares.argmin(axis=2)
            low = np.take_along_axis(squares, nearest[:, :, None], axis=2)[:, :, 0]
            closer = low < least  # keys ascend, so an equal distance leaves the smaller key
            least[closer], which[closer] = low[closer], nearest[closer] + at
        grid_row, grid_col = np.meshgrid(row, col, indexing="ij")
        chosen = which.ravel()
        out = {"row": grid_row.ravel().astype("int32"), "col": grid_col.ravel().astype("int32")}
        return pd.DataFrame(out | {n: found[n].to_numpy()[chosen] for n in names})

    schema = ", ".join(["row int", "col int", *[f"{n} double" for n in names]])
    result = met.groupBy("tile_row", "tile_col").applyInPandas(in_tile, schema)
    return result.select(*CELL, *[F.col(n).alias(v) for n, v in zip(names, values)])


def nearest_value(
    points: DataFrame,
    value: str,
    region: Region,
    key: str,
    x: str = "x",
    y: str = "y",
) -> DataFrame:
    """Value of the nearest point for every cell; see `nearest_values`."""
    return nearest_values(points, [value], region, key, x, y).withColumnRenamed(value, "value")
