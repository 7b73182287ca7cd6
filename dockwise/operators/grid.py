"""Grid operators on cell tables (row, col, value).

An absent row or a null value is an empty cell. Rows count from the south,
columns from the west. A layer holds at most one value per cell.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CELL = ("row", "col")

# Cell sides in feet, and the area of a medium cell.
FINE_RES = 10
MEDIUM_RES = 100
MEDIUM_CELL_AREA = MEDIUM_RES**2


def _index(v: Column, start: float, res: float, count: int) -> Column:
    """Cell index of a coordinate, null outside the extent."""
    offset = (v - F.lit(start)) / F.lit(res)
    index = F.least(F.floor(offset), F.lit(count - 1))
    return F.when(offset.between(0.0, float(count)), index).try_cast("int")


@dataclass(frozen=True)
class Region:
    """Extent and resolution of a grid."""

    west: float
    south: float
    res: float
    rows: int
    cols: int

    @property
    def east(self) -> float:
        return self.west + self.cols * self.res

    @property
    def north(self) -> float:
        return self.south + self.rows * self.res

    def col_of(self, x: Column) -> Column:
        """Column of an x position; the east edge belongs to the last column."""
        return _index(x, self.west, self.res, self.cols)

    def row_of(self, y: Column) -> Column:
        """Row of a y position; the north edge belongs to the last row."""
        return _index(y, self.south, self.res, self.rows)

    def x_of(self, col: Column) -> Column:
        return F.lit(self.west) + (col + 0.5) * F.lit(self.res)

    def y_of(self, row: Column) -> Column:
        return F.lit(self.south) + (row + 0.5) * F.lit(self.res)

    def cells(self, spark: SparkSession) -> DataFrame:
        """Every cell of the region, made in parallel."""
        index = spark.range(self.rows * self.cols)
        row = F.expr(f"cast(id div {self.cols} as int)").alias("row")
        return index.select(row, (F.col("id") % self.cols).cast("int").alias("col"))


def region_bounds(df: DataFrame, res: float, x: str = "x", y: str = "y") -> DataFrame:
    """Extent of a point layer and the number of cells it takes, one row."""
    bounds = df.agg(
        F.min(x).alias("west"),
        F.min(y).alias("south"),
        F.max(x).alias("_east"),
        F.max(y).alias("_north"),
    )

    def count(low: str, high: str) -> Column:
        cells = F.ceil((F.col(high) - F.col(low)) / F.lit(float(res)))
        return F.greatest(cells, F.lit(1)).cast("int")

    return bounds.select(
        "west",
        "south",
        F.lit(float(res)).alias("res"),
        count("south", "_north").alias("rows"),
        count("west", "_east").alias("cols"),
    )


def set_region(df: DataFrame, res: float, x: str = "x", y: str = "y") -> Region:
    """Region of a layer's extent: one aggregated row comes to the driver."""
    return Region(**region_bounds(df, res, x, y).first().asDict())


def located(points: DataFrame, region: Region, x: str, y: str) -> DataFrame:
    """Points of the region with their row and column."""
    placed = points.withColumns({"row": region.row_of(F.col(y)), "col": region.col_of(F.col(x))})
    return placed.filter(F.col("row").isNotNull() & F.col("col").isNotNull())


def fill_empty(cells: DataFrame, region: Region, value: float = 0.0) -> DataFrame:
    """Every cell of the region, empty ones holding `value`."""
    blank = region.cells(cells.sparkSession).withColumn("value", F.lit(None).cast("double"))
    both = cells.select(*CELL, F.col("value").cast("double")).unionByName(blank)
    return both.groupBy(*CELL).agg(F.coalesce(F.max("value"), F.lit(float(value))).alias("value"))


def fill_within(cells: DataFrame, area: DataFrame, value: float = 0.0) -> DataFrame:
    """Every cell of an area, empty ones holding `value`; cells outside are left out."""
    inside = area.select(*CELL, F.lit(None).cast("double").alias("value"), F.lit(True).alias("_inside"))
    both = inside.unionByName(cells.select(*CELL, F.col("value").cast("double"), F.lit(False).alias("_inside")))
    held = both.groupBy(*CELL).agg(F.max("value").alias("value"), F.max("_inside").alias("_inside"))
    return held.filter("_inside").select(*CELL, F.coalesce("value", F.lit(float(value))).alias("value"))


def bin_sum(
    points: DataFrame,
    value: str | None,
    region: Region,
    x: str = "x",
    y: str = "y",
    fill: bool = False,
) -> DataFrame:
    """Sum of a value (or number of points) per cell; `fill` adds the empty cells as 0."""
    amount = F.lit(1.0) if value is None else F.col(value).cast("double")
    sums = located(points, region, x, y).groupBy(*CELL).agg(F.sum(amount).alias("value"))
    return fill_empty(sums, region) if fill else sums


def rasterize_points(
    points: DataFrame, value: str | None, region: Region, key: str, x: str = "x", y: str = "y"
) -> DataFrame:
    """Attribute (or 1) of the point in each cell; of several, the one with the largest key."""
    amount = F.lit(1.0) if value is None else F.col(value).cast("double")
    placed = located(points, region, x, y).withColumn("_value", amount)
    return placed.groupBy(*CELL).agg(F.max_by("_value", key).alias("value"))


def burn_categories(
    cells: DataFrame,
    rules: Sequence[tuple[object, float]],
    category: str = "value",
    nodata: float | None = None,
) -> DataFrame:
    """Constants by category, the last rule that matches winning."""
    result = F.lit(nodata).cast("double")
    for wanted, constant in rules:
        matches = F.col(category) == F.lit(wanted)
        result = F.when(matches, F.lit(float(constant))).otherwise(result)
    return cells.select(*CELL, result.alias("value"))


def reclass_codes(cells: DataFrame, rules: Mapping[float | None, Sequence[int]]) -> DataFrame:
    """Listed codes to a value; a None key and unlisted codes empty the cell."""
    result = F.lit(None).cast("double")
    for target, codes in rules.items():
        new = F.lit(target).cast("double")
        result = F.when(F.col("value").isin(*codes), new).otherwise(result)
    return cells.select(*CELL, result.alias("value")).filter(F.col("value").isNotNull())


def reclass_invert(cells: DataFrame) -> DataFrame:
    """0 to 1 and 1 to 0; anything else empties the cell."""
    value = F.col("value")
    return cells.select(
        *CELL, F.when(value == 0, 1.0).when(value == 1, 0.0).alias("value")
    ).filter(F.col("value").isNotNull())


def reclass_distance(cells: DataFrame, lo: int, hi: int) -> DataFrame:
    """1 where the whole-foot distance is in the band, else 0.

    The band is [lo, hi]; with lo = 0 it is [0, hi - 1].
    """
    whole = F.floor(F.col("value"))
    inside = whole <= hi - 1 if lo == 0 else whole.between(lo, hi)
    return cells.select(*CELL, inside.cast("double").alias("value"))


def null_if(cells: DataFrame, value: float) -> DataFrame:
    """Empty the cells that hold a value."""
    return cells.filter(F.col("value") != value)


def mask(cells: DataFrame, mask_cells: DataFrame) -> DataFrame:
    """Cells where the mask is not empty."""
    active = mask_cells
    if "value" in active.columns:
        active = active.filter(F.col("value").isNotNull())
    return cells_within(cells, active)


def cells_within(cells: DataFrame, area: DataFrame) -> DataFrame:
    """Rows whose cell is in the other table.

    Both sides are shuffled by cell. What a rasterised layer weighs is not known
    before it is made, so the planner must not broadcast it on a guess; cells
    are unique, so no key is hot.
    """
    return cells.join(area.select(*CELL).hint("merge"), list(CELL), "left_semi")


def unmask(cells: DataFrame) -> DataFrame:
    """No mask: masks are arguments here, so there is nothing to lift."""
    return cells


def copy_layer(cells: DataFrame) -> DataFrame:
    """The same cells under another name."""
    return cells.select(*CELL, "value")


def cap(cells: DataFrame, limit: float) -> DataFrame:
    """min(value, limit); empty stays empty."""
    return cells.select(*CELL, _guarded(F.least, limit))


def floor_at(cells: DataFrame, limit: float) -> DataFrame:
    """max(value, limit); empty stays empty."""
    return cells.select(*CELL, _guarded(F.greatest, limit))


def _guarded(function, limit: float) -> Column:
    value = F.col("value").cast("double")
    return F.when(value.isNotNull(), function(value, F.lit(float(limit)))).alias("value")


def inverse_distance(cells: DataFrame, floor: float, scale: float = 10000) -> DataFrame:
    """scale / sqrt(max(distance, floor))."""
    floored = floor_at(cells, floor)
    return floored.select(
        *CELL, (F.pow("value", F.lit(-0.5)) * F.lit(float(scale))).alias("value")
    )


def min_max(cells: DataFrame, value: str = "value") -> DataFrame:
    """Smallest and largest value, one row."""
    return cells.agg(F.min(value).alias("min_value"), F.max(value).alias("max_value"))


def normalize(cells: DataFrame, lo: float = 1, hi: float = 100) -> DataFrame:
    """Rescale the values' own range to [lo, hi]; a constant layer becomes lo.

    The bounds come from a scalar subquery over the same cells, so an upstream
    that is costly should be settled first.
    """
    bounds = min_max(cells).select(F.struct("min_value", "max_value"))
    bounded = cells.select(*CELL, "value", bounds.scalar().alias("_bounds"))
    low, high = F.col("_bounds.min_value"), F.col("_bounds.max_value")
    share = F.coalesce(F.try_divide(F.col("value") - low, high - low), F.lit(0.0))
    scaled = F.when(F.col("value").isNotNull(), F.lit(float(lo)) + F.lit(float(hi - lo)) * share)
    return bounded.select(*CELL, scaled.alias("value"))


def stack_layers(**layers: DataFrame) -> DataFrame:
    """One column per layer on (row, col), null where a layer is empty.

    The layers are laid one on the other and grouped once, which shuffles each
    cell a single time however many layers there are.
    """
    tagged = [
        cells.select(*CELL, F.lit(name).alias("_layer"), F.col("value").cast("double"))
        for name, cells in layers.items()
    ]
    long = reduce(DataFrame.unionByName, tagged)
    picks = [
        F.max(F.when(F.col("_layer") == name, F.col("value"))).alias(name) for name in layers
    ]
    return long.groupBy(*CELL).agg(*picks)


def cell_algebra(expr: Column | str, **layers: DataFrame) -> DataFrame:
    """An expression over aligned layers, empty where the result is null.

    A single layer is not aligned with anything: its cells are not shuffled.
    """
    column = F.expr(expr) if isinstance(expr, str) else expr
    if len(layers) == 1:
        [(name, cells)] = layers.items()
        stacked = cells.select(*CELL, F.col("value").cast("double").alias(name))
    else:
        stacked = stack_layers(**layers)
    result = stacked.select(*CELL, column.cast("double").alias("value"))
    return result.filter(F.col("value").isNotNull())


def _covered(first: Column, last: Column, limit: int) -> Column:
    """Indices whose centres lie in [first, last), given in target cell units."""
    low = F.greatest(F.ceil(first - 0.5), F.lit(0))
    high = F.least(F.ceil(last - 0.5) - 1, F.lit(limit - 1))
    return F.when(low <= high, F.sequence(low, high))


def resample_nearest(cells: DataFrame, src: Region, dst: Region) -> DataFrame:
    """Each target cell takes the source cell its centre lies in.

    Every source cell names the target cells it feeds: no join, no shuffle.
    """

    def targets(index: str, src_start: float, dst_start: float, limit: int) -> Column:
        begin = (F.lit(src_start - dst_start) + F.col(index) * F.lit(src.res)) / F.lit(dst.res)
        end = (F.lit(src_start - dst_start) + (F.col(index) + 1) * F.lit(src.res)) / F.lit(dst.res)
        return F.explode(_covered(begin, end, limit))

    by_row = cells.withColumn("_row", targets("row", src.south, dst.south, dst.rows))
    by_col = by_row.withColumn("_col", targets("col", src.west, dst.west, dst.cols))
    return by_col.select(
        F.col("_row").cast("int").alias("row"), F.col("_col").cast("int").alias("col"), "value"
    )


def window_radius(radius: float, res: float) -> int:
    """Cells from the centre of the odd-sized window a walking radius spans."""
    size = int((radius * 2) // res)
    return (size + 1 if size % 2 == 0 else size) // 2


def tile_side(region: Region, reach: int, side: int) -> int:
    """Side of the square tiles: no larger than the region, no smaller than the halo."""
    return max(min(side, max(region.rows, region.cols)), reach, 1)


def halo_tiles(cells: DataFrame, region: Region, side: int, halo: int) -> DataFrame:
    """Cells keyed by square tile, copied into each tile whose halo they touch.

    A tile with its halo holds at most (side + 2 * halo)^2 cells, whatever the
    size of the region.
    """

    def touched(index: str, count: int) -> Column:
        first = F.floor((F.col(index) - halo) / F.lit(side)).cast("int")
        last = F.floor((F.col(index) + halo) / F.lit(side)).cast("int")
        final = (count - 1) // side
        return F.explode(
            F.sequence(F.greatest(first, F.lit(0)), F.least(last, F.lit(final)))
        )

    by_row = cells.withColumn("tile_row", touched("row", region.rows))
    return by_row.withColumn("tile_col", touched("col", region.cols))


def _disc_sum(values: np.ndarray, present: np.ndarray, side: int, radius: int):
    """Sums and counts over the disc around each inner cell of a haloed tile."""
    sums = np.zeros((side, side))
    counts = np.zeros((side, side))
    for layer, total in ((values, sums), (present, counts)):
        running = np.zeros((layer.shape[0], layer.shape[1] + 1))
        np.cumsum(layer, axis=1, out=running[:, 1:])
        for dy in range(-radius, radius + 1):
            half = math.isqrt(radius * radius - dy * dy)
            rows = running[radius + dy : radius + dy + side]
            left, right = radius - half, radius + half + 1
            total += rows[:, right : right + side] - rows[:, left : left + side]
    return sums, counts


def focal_sum(
    cells: DataFrame, radius: float, region: Region, fill: bool = False, side: int = 512
) -> DataFrame:
    """Sum over the disc of cells within the walking radius of each cell.

    Empty cells add nothing; a cell whose whole disc is empty stays empty
    unless `fill` is set. Each tile is summed on its own from the cells in and
    around it, so the shuffle carries every cell about once.
    """
    reach = window_radius(radius, region.res)
    side = tile_side(region, reach, side)
    width = side + 2 * reach
    rows, cols = region.rows, region.cols

    def tile_sums(key: tuple, tile: pd.DataFrame) -> pd.DataFrame:
        top, left = key[0] * side, key[1] * side
        at = (tile["row"].to_numpy() - top + reach, tile["col"].to_numpy() - left + reach)
        values, present = np.zeros((width, width)), np.zeros((width, width))
        values[at] = tile["value"].to_numpy()
        present[at] = 1.0
        sums, counts = _disc_sum(values, present, side, reach)
        row, col = np.nonzero(counts > 0.5)
        inside = (row + top < rows) & (col + left < cols)
        row, col = row[inside], col[inside]
        return pd.DataFrame(
            {
                "row": (row + top).astype("int32"),
                "col": (col + left).astype("int32"),
                "value": sums[row, col],
            }
        )

    known = cells.select(*CELL, F.col("value").cast("double")).filter(F.col("value").isNotNull())
    tiles = halo_tiles(known, region, side, reach).groupBy("tile_row", "tile_col")
    sums = tiles.applyInPandas(tile_sums, "row int, col int, value double")
    return fill_empty(sums, region) if fill else sums


def classify_breaks(df: DataFrame, col: str, breaks: Sequence[float]) -> DataFrame:
    """Number of rows per class, class k holding values up to the k-th break.

    Values above the last break fall in no class (null).
    """
    ladder = None
    for k, upper in enumerate(breaks, start=1):
        ladder = (
            F.when(F.col(col) <= upper, k)
            if ladder is None
            else ladder.when(F.col(col) <= upper, k)
        )
    return df.groupBy(ladder.alias("class")).agg(F.count(F.lit(1)).alias("n"))


