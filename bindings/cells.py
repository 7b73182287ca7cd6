"""Grid operators on points, lines and triangles taken from the embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bindings.registry import bind, piece, sql, table
from dockwise.functions.geometry import parts_area, polygon_area
from dockwise.operators import distance as d
from dockwise.operators import grid as g
from dockwise.operators import vector as v

MEDIUM = g.Region(-500.0, -500.0, 20.0, 50, 50)
FINE = g.Region(-500.0, -500.0, 10.0, 100, 100)
RADIUS = 100
REACH = 5  # cells in RADIUS at the medium resolution


def _dims(first: int) -> str:
    return f"CAST(embedding[{first}] AS DOUBLE) * 1000 AS x, CAST(embedding[{first + 1}] AS DOUBLE) * 1000 AS y"


def points(spark, sf, first: int = 1) -> DataFrame:
    """Points from two neighbouring dimensions, counted from 1."""
    at = [F.col("embedding")[first - 1 + i].cast("double") * 1000 for i in (0, 1)]
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"),
        at[0].alias("x"),
        at[1].alias("y"),
        F.col("label").cast("double").alias("value"),
    )


for _first in (1, 3, 5, 7, 9, 11):
    piece(
        f"points{_first}",
        f"SELECT vec_id AS id, {_dims(_first)}, CAST(label AS DOUBLE) AS value FROM embeddings",
    )


def place(name: str, source: str, region: g.Region) -> str:
    """Points with their cell."""
    def index(c: str, start: float, n: int) -> str:
        offset = f"({c} - {start}::DOUBLE) / {region.res}::DOUBLE"
        return (
            f"CAST(least(floor({offset}), {n - 1}) AS INTEGER)",
            f"{offset} BETWEEN 0 AND {n}",
        )

    row, row_in = index("y", region.south, region.rows)
    col, col_in = index("x", region.west, region.cols)
    piece(name, f"SELECT *, {row} AS row, {col} AS col FROM {source} WHERE {row_in} AND {col_in}")
    return name


for _first in (1, 3, 5, 7, 9, 11):
    place(f"medium{_first}", f"points{_first}", MEDIUM)
    place(f"fine{_first}", f"points{_first}", FINE)

GRID = "SELECT CAST(r.range AS INTEGER) AS row, CAST(c.range AS INTEGER) AS col FROM range({rows}) r, range({cols}) c"
piece("medium_grid", GRID.format(rows=MEDIUM.rows, cols=MEDIUM.cols))
piece("fine_grid", GRID.format(rows=FINE.rows, cols=FINE.cols))
piece("bins", "SELECT row, col, sum(value) AS value FROM medium1 GROUP BY ALL")
piece("other_bins", "SELECT row, col, sum(value) AS value FROM medium3 GROUP BY ALL")
piece("sources", "SELECT DISTINCT row, col FROM medium1")


def bins(spark, sf, first: int = 1) -> DataFrame:
    return g.bin_sum(points(spark, sf, first), "value", MEDIUM)


def full_bins(spark, sf, first: int = 1) -> DataFrame:
    return g.bin_sum(points(spark, sf, first), "value", MEDIUM, fill=True)


FULL = """
    SELECT row, col, coalesce(value, 0) AS value
    FROM medium_grid LEFT JOIN {bins} USING (row, col)
"""
piece("full_bins", FULL.format(bins="bins"))
piece("full_other", FULL.format(bins="other_bins"))


@bind("bin_sum", sql("SELECT * FROM bins"))
def bin_sum(spark, sf):
    return bins(spark, sf)


@bind("bin_sum_filled", sql("SELECT * FROM full_bins"))
def bin_sum_filled(spark, sf):
    return full_bins(spark, sf)


# line items by price and day: the largest layer
PRICES = g.Region(0.0, 0.0, 1000.0, 60, 120)
place("priced", "(SELECT l_extendedprice AS x, l_quantity * 1000 AS y, l_partkey AS value FROM lineitem)", PRICES)


def _priced(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        F.col("l_extendedprice").alias("x"),
        (F.col("l_quantity") * 1000).alias("y"),
        F.col("l_partkey").alias("value"),
    )
    return g.bin_sum(rows, "value", PRICES)


@bind(
    "bin_sum_lineitem",
    sql("SELECT row, col, sum(CAST(value AS DOUBLE)) AS value FROM priced GROUP BY ALL"),
)
def bin_sum_lineitem(spark, sf):
    return _priced(spark, sf)


@bind(
    "focal_sum_lineitem",
    sql(
        """
        SELECT CAST(b.row + dy.range AS INTEGER) AS row, CAST(b.col + dx.range AS INTEGER) AS col,
               sum(value) AS value
        FROM (SELECT row, col, sum(CAST(value AS DOUBLE)) AS value FROM priced GROUP BY ALL) b,
             range(-4, 5) dy, range(-4, 5) dx
        WHERE dy.range * dy.range + dx.range * dx.range <= 16
          AND b.row + dy.range BETWEEN 0 AND 59 AND b.col + dx.range BETWEEN 0 AND 119
        GROUP BY ALL
        """
    ),
)
def focal_sum_lineitem(spark, sf):
    return g.focal_sum(_priced(spark, sf), 4000, PRICES, side=16)


@bind("min_max", sql("SELECT min(value) AS min_value, max(value) AS max_value FROM bins"))
def min_max(spark, sf):
    return g.min_max(bins(spark, sf))


@bind(
    "set_region",
    sql(
        """
        SELECT min(x) AS west, min(y) AS south, 20.0::DOUBLE AS res,
               CAST(greatest(ceil((max(y) - min(y)) / 20), 1) AS INTEGER) AS rows,
               CAST(greatest(ceil((max(x) - min(x)) / 20), 1) AS INTEGER) AS cols
        FROM points1
        """
    ),
)
def set_region(spark, sf):
    return g.region_bounds(points(spark, sf), 20.0)


@bind(
    "rasterize_points",
    sql("SELECT row, col, arg_max(value, id) AS value FROM medium1 GROUP BY ALL"),
)
def rasterize_points(spark, sf):
    return g.rasterize_points(points(spark, sf), "value", MEDIUM, "id")


# --- lines: three vertices per embedding ---

piece(
    "segments",
    """
    SELECT vec_id AS id, label AS value, i,
           CAST(embedding[2 * i + 1] AS DOUBLE) * 1000 AS x1, CAST(embedding[2 * i + 2] AS DOUBLE) * 1000 AS y1,
           CAST(embedding[2 * i + 3] AS DOUBLE) * 1000 AS x2, CAST(embedding[2 * i + 4] AS DOUBLE) * 1000 AS y2
    FROM embeddings, (VALUES (0), (1)) v(i)
    """,
)


def lines(spark, sf) -> DataFrame:
    e = F.col("embedding")
    vertices = [
        F.struct(
            (e[2 * i].cast("double") * 1000).alias("x"), (e[2 * i + 1].cast("double") * 1000).alias("y")
        )
        for i in range(3)
    ]
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"),
        F.col("label").cast("double").alias("value"),
        F.array(F.array(*vertices)).alias("paths"),
        F.array(F.array(F.array(*vertices))).alias("parts"),
    )


piece(
    "touched",
    """
    SELECT id, value, row, col FROM (
        SELECT s.id, s.value, g.row, g.col,
               (-500 + g.col * 20 - x1) / (x2 - x1) AS ta, (-480 + g.col * 20 - x1) / (x2 - x1) AS tb,
               (-500 + g.row * 20 - y1) / (y2 - y1) AS tc, (-480 + g.row * 20 - y1) / (y2 - y1) AS td
        FROM segments s, medium_grid g)
    WHERE greatest(least(ta, tb), least(tc, td), 0) <= least(greatest(ta, tb), greatest(tc, td), 1)
    """,
)


@bind(
    "rasterize_lines",
    sql("SELECT row, col, CAST(arg_max(value, id) AS DOUBLE) AS value FROM touched GROUP BY ALL"),
)
def rasterize_lines(spark, sf):
    return v.rasterize_lines(lines(spark, sf), "value", MEDIUM, "id")


# --- triangles: three vertices per embedding ---

piece(
    "triangles",
    "SELECT vec_id AS id, label AS value, "
    + ", ".join(
        f"CAST(embedding[{2 * i + 1}] AS DOUBLE) * 1000 AS x{i}, CAST(embedding[{2 * i + 2}] AS DOUBLE) * 1000 AS y{i}"
        for i in range(3)
    )
    + " FROM embeddings",
)


def _inside(px: str, py: str) -> str:
    crossings = [
        f"CASE WHEN (y{a} > {py}) <> (y{b} > {py})"
        f" AND {px} < ({py} - y{a}) * (x{b} - x{a}) / (y{b} - y{a}) + x{a} THEN 1 ELSE 0 END"
        for a, b in ((0, 1), (1, 2), (2, 0))
    ]
    return f"({' + '.join(crossings)}) % 2 = 1"


CX, CY = "(-490.0::DOUBLE + g.col * 20)", "(-490.0::DOUBLE + g.row * 20)"
piece(
    "covered",
    f"SELECT t.id, t.value, g.row, g.col FROM triangles t, medium_grid g WHERE {_inside(CX, CY)}",
)


@bind(
    "rasterize_polygons",
    sql("SELECT row, col, CAST(arg_max(value, id) AS DOUBLE) AS value FROM covered GROUP BY ALL"),
)
def rasterize_polygons(spark, sf):
    return v.rasterize_polygons(lines(spark, sf), "value", MEDIUM, "id")


@bind("polygon_cells", sql("SELECT id, row, col FROM covered"))
def polygon_cells(spark, sf):
    return v.polygon_cells(lines(spark, sf), MEDIUM, ["id"])


@bind(
    "clip_points",
    sql(
        f"""
        SELECT id, x, y, value FROM points7 p
        WHERE EXISTS (SELECT 1 FROM triangles t WHERE {_inside("p.x", "p.y")})
        """
    ),
)
def clip_points(spark, sf):
    return v.clip_points(points(spark, sf, 7), lines(spark, sf), 50.0)


@bind(
    "clip_cells",
    sql(
        """
        SELECT id, count(*) AS cells, count(*) * 400.0::DOUBLE AS area FROM covered
        WHERE (row, col) IN (SELECT (row, col) FROM sources) GROUP BY id
        """
    ),
)
def clip_cells(spark, sf):
    cells = v.polygon_cells(lines(spark, sf), MEDIUM, ["id"])
    return v.clip_cells(cells, bins(spark, sf), MEDIUM, "id")


SHOELACE = (
    "abs((x0 * y1 - x1 * y0) + (x1 * y2 - x2 * y1) + (x2 * y0 - x0 * y2)) / 2"
)


@bind("polygon_area", sql(f"SELECT id, round({SHOELACE}, 6) AS area FROM triangles"))
def area_of_polygon(spark, sf):
    return lines(spark, sf).select("id", F.round(polygon_area(F.col("parts")[0]), 6).alias("area"))


@bind(
    "polygon_area_with_hole",
    sql(f"SELECT id, round(4000000 - {SHOELACE} + {SHOELACE}, 5) AS area FROM triangles"),
)
def area_with_hole(spark, sf):
    corners = [(-1000, -1000), (1000, -1000), (1000, 1000), (-1000, 1000)]
    square = F.array(
        *[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in corners]
    )
    hole = F.col("paths")[0]
    parts = F.array(F.array(square, hole), F.array(hole))
    return lines(spark, sf).select("id", F.round(parts_area(parts), 5).alias("area"))


# --- cells ---


@bind(
    "burn_categories",
    sql(
        """
        SELECT row, col, CASE WHEN value = 0 THEN 50.0 WHEN value IN (1, 2, 3) THEN -50.0 END::DOUBLE
               AS value FROM full_bins
        """
    ),
)
def burn_categories(spark, sf):
    rules = [(0, 0), (1, -50), (2, -50), (3, -50), (0, 50)]
    return g.burn_categories(full_bins(spark, sf), rules)


@bind("reclass_codes", sql("SELECT row, col, 1.0::DOUBLE AS value FROM bins WHERE value IN (1, 3, 5, 6, 7)"))
def reclass_codes(spark, sf):
    return g.reclass_codes(bins(spark, sf), {1: [1, 3, 5, 6, 7], None: [2, 4, 8]})


@bind(
    "reclass_invert",
    sql("SELECT row, col, CASE WHEN (row, col) IN (SELECT (row, col) FROM sources) THEN 0.0 ELSE 1.0 END::DOUBLE AS value FROM medium_grid"),
)
def reclass_invert(spark, sf):
    return g.reclass_invert(g.fill_empty(g.bin_sum(points(spark, sf), None, MEDIUM).selectExpr("row", "col", "1D AS value"), MEDIUM))


piece(
    "distances",
    """
    SELECT g.row, g.col,
           sqrt(CAST(min((g.row - s.row) * (g.row - s.row) + (g.col - s.col) * (g.col - s.col)) AS DOUBLE))
               * 20.0::DOUBLE AS value
    FROM medium_grid g, sources s GROUP BY ALL
    """,
)


def distances(spark, sf):
    return d.distance_to_nearest(bins(spark, sf), MEDIUM)


@bind("distance_to_nearest", sql("SELECT * FROM distances"))
def distance_to_nearest(spark, sf):
    return distances(spark, sf)


@bind("distance_to_nearest_in_band", sql("SELECT * FROM distances WHERE value <= 90"))
def distance_in_band(spark, sf):
    return d.distance_to_nearest(bins(spark, sf), MEDIUM, max_dist=90)


@bind(
    "reclass_distance",
    sql("SELECT row, col, CASE WHEN floor(value) BETWEEN 20 AND 89 THEN 1.0 ELSE 0.0 END::DOUBLE AS value FROM distances"),
)
def reclass_distance(spark, sf):
    return g.reclass_distance(distances(spark, sf), 20, 89)


@bind(
    "reclass_distance_from_zero",
    sql("SELECT row, col, CASE WHEN floor(value) <= 88 THEN 1.0 ELSE 0.0 END::DOUBLE AS value FROM distances"),
)
def reclass_distance_from_zero(spark, sf):
    return g.reclass_distance(distances(spark, sf), 0, 89)


def nearest_sql(source: str, value: str = "s.value") -> str:
    """Value of the point nearest to each medium cell's centre, by exact coordinates."""
    return f"""
    SELECT g.row, g.col, arg_min({value}, (g.dx * g.dx + g.dy * g.dy, g.id)) AS value
    FROM (SELECT m.row, m.col, s.*, {MEDIUM.west}::DOUBLE + (m.col + 0.5::DOUBLE) * {MEDIUM.res}::DOUBLE - s.x AS dx,
                 {MEDIUM.south}::DOUBLE + (m.row + 0.5::DOUBLE) * {MEDIUM.res}::DOUBLE - s.y AS dy
          FROM medium_grid m, (SELECT id, x, y, value FROM {source}) s) g
    GROUP BY ALL
    """.replace("s.value", "g.value")


piece("nearest", nearest_sql("medium1"))


@bind("nearest_value", sql("SELECT * FROM nearest"))
def nearest_value(spark, sf):
    return d.nearest_value(points(spark, sf), "value", MEDIUM, "id")


def disc(name: str, source: str, reach: int = REACH) -> str:
    """Sum of a layer over the disc around each cell of the medium grid."""
    piece(
        name,
        f"""
        SELECT CAST(s.row + dy.range AS INTEGER) AS row, CAST(s.col + dx.range AS INTEGER) AS col,
               sum(s.value) AS value
        FROM {source} s, range({-reach}, {reach + 1}) dy, range({-reach}, {reach + 1}) dx
        WHERE dy.range * dy.range + dx.range * dx.range <= {reach * reach}
          AND s.row + dy.range BETWEEN 0 AND {MEDIUM.rows - 1}
          AND s.col + dx.range BETWEEN 0 AND {MEDIUM.cols - 1}
        GROUP BY ALL
        """,
    )
    return name


disc("bin_discs", "bins")


@bind("focal_sum", sql("SELECT * FROM bin_discs"))
def focal_sum(spark, sf):
    return g.focal_sum(bins(spark, sf), RADIUS, MEDIUM)


@bind("focal_sum_filled", sql(FULL.format(bins="bin_discs")))
def focal_sum_filled(spark, sf):
    return g.focal_sum(bins(spark, sf), RADIUS, MEDIUM, fill=True, side=16)


@bind(
    "resample_nearest",
    sql(
        """
        SELECT f.row, f.col, value FROM fine_grid f JOIN bins b ON b.row = f.row // 2 AND b.col = f.col // 2
        """
    ),
)
def resample_nearest(spark, sf):
    return g.resample_nearest(bins(spark, sf), MEDIUM, FINE)


@bind(
    "resample_nearest_coarser",
    sql(
        """
        SELECT m.row, m.col, value FROM medium_grid m
        JOIN (SELECT row, col, sum(value) AS value FROM fine1 GROUP BY ALL) f
          ON f.row = 2 * m.row + 1 AND f.col = 2 * m.col + 1
        """
    ),
)
def resample_nearest_coarser(spark, sf):
    fine = g.bin_sum(points(spark, sf), "value", FINE)
    return g.resample_nearest(fine, FINE, MEDIUM)


@bind(
    "mask",
    sql("SELECT * FROM full_other WHERE (row, col) IN (SELECT (row, col) FROM sources)"),
)
def mask(spark, sf):
    return g.mask(full_bins(spark, sf, 3), bins(spark, sf))


@bind("unmask", sql("SELECT * FROM bins"))
def unmask(spark, sf):
    return g.unmask(bins(spark, sf))


@bind("copy_layer", sql("SELECT * FROM bins"))
def copy_layer(spark, sf):
    return g.copy_layer(bins(spark, sf))


@bind("null_if", sql("SELECT * FROM full_bins WHERE value <> 0"))
def null_if(spark, sf):
    return g.null_if(full_bins(spark, sf), 0)


@bind(
    "cell_algebra",
    sql(
        """
        SELECT row, col, a.value * 2 - b.value / 4 AS value
        FROM bins a JOIN full_other b USING (row, col)
        """
    ),
)
def cell_algebra(spark, sf):
    return g.cell_algebra("a * 2 - b / 4", a=bins(spark, sf), b=full_bins(spark, sf, 3))


@bind("cap", sql("SELECT row, col, least(value, 7) AS value FROM bins"))
def cap(spark, sf):
    return g.cap(bins(spark, sf), 7)


@bind("floor_at", sql("SELECT row, col, greatest(value, 7) AS value FROM bins"))
def floor_at(spark, sf):
    return g.floor_at(bins(spark, sf), 7)


@bind(
    "inverse_distance",
    sql(
        "SELECT row, col, round(pow(greatest(value, 20), -0.5::DOUBLE) * 10000, 6) AS value FROM distances"
    ),
)
def inverse_distance(spark, sf):
    cells = g.inverse_distance(distances(spark, sf), 20)
    return cells.withColumn("value", F.round("value", 6))


def norm(source: str) -> str:
    return f"""
        SELECT row, col,
               1.0::DOUBLE + 99.0::DOUBLE * coalesce((value - lo) / nullif(hi - lo, 0), 0) AS value
        FROM ({source}), (SELECT min(value) AS lo, max(value) AS hi FROM ({source}))
    """


@bind("normalize", sql(norm("SELECT * FROM bins")))
def normalize(spark, sf):
    return g.normalize(bins(spark, sf))


BREAKS = (24.6, 49.2, 73.8, 98.4, 123.0)


@bind(
    "classify_breaks",
    "SELECT CASE "
    + " ".join(f"WHEN c_acctbal / 50 <= {b}::DOUBLE THEN {k}" for k, b in enumerate(BREAKS, 1))
    + " END AS class, count(*) AS n FROM customer GROUP BY ALL",
)
def classify_breaks(spark, sf):
    rows = table(spark, sf, "customer").select((F.col("c_acctbal") / 50).alias("value"))
    return g.classify_breaks(rows, "value", BREAKS)
