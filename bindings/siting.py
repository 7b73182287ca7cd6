"""Siting model on layers binned from the embeddings' dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bindings.cells import FINE, FULL, MEDIUM, RADIUS, bins, disc, full_bins, lines, nearest_sql, norm, points
from bindings.registry import bind, piece, sql
from dockwise.operators import distance as d
from dockwise.operators import grid as g
from dockwise.plans import siting as s
from dockwise.session import settle, settle_all

# distances of the small test map
STATION_MIN, STATION_MAX, STREET_MAX = 10, RADIUS, 30
WEIGHTS = {"service": 3, "transit": 2, "expansion": 1, "profit": 2, "safety": 2}

# --- layers ---

# the boroughs: a part of the map with a bay in the west and land of others in the east
OUTSIDE = "(col >= 80 OR (col < 40 AND row BETWEEN 40 AND 55))"
piece("borough_fine", f"SELECT row, col FROM fine_grid WHERE NOT {OUTSIDE}")
piece("borough_medium", "SELECT m.row, m.col FROM medium_grid m JOIN borough_fine f ON f.row = 2 * m.row + 1 AND f.col = 2 * m.col + 1")
piece("stations_fine", "SELECT DISTINCT row, col FROM fine1 JOIN borough_fine USING (row, col)")
piece("streets_fine", "SELECT row, col, arg_max(value, id) AS value FROM fine3 GROUP BY ALL")
piece("bikeable_fine", "SELECT row, col FROM streets_fine WHERE value IN (1, 3, 5, 6, 7, 10, 11, 13)")
piece("bikeable_land", "SELECT row, col FROM bikeable_fine JOIN borough_fine USING (row, col)")


def _fine_distance(name: str, source: str) -> None:
    piece(
        name,
        f"""
        SELECT g.row, g.col,
               sqrt(CAST(min((g.row - s.row) * (g.row - s.row)
                             + (g.col - s.col) * (g.col - s.col)) AS DOUBLE)) * 10 AS value
        FROM fine_grid g, {source} s GROUP BY ALL
        """,
    )


_fine_distance("station_distance", "stations_fine")
_fine_distance("street_distance", "bikeable_land")
piece(
    "allowed",
    f"""
    SELECT a.row, a.col,
           CASE WHEN floor(a.value) BETWEEN {STATION_MIN} AND {STATION_MAX}
                 AND floor(b.value) < {STREET_MAX} THEN 1.0 ELSE 0.0 END::DOUBLE AS value
    FROM station_distance a JOIN street_distance b USING (row, col) JOIN borough_fine USING (row, col)
    """,
)
piece(
    "served",
    f"""
    SELECT m.row, m.col, CASE WHEN floor(f.value) < {RADIUS} THEN 1.0 ELSE 0.0 END::DOUBLE AS value
    FROM borough_medium m JOIN station_distance f ON f.row = 2 * m.row + 1 AND f.col = 2 * m.col + 1
    """,
)
piece("active", "SELECT row, col FROM served WHERE value = 1")
piece("unserved", "SELECT row, col, 1 - value AS value FROM served")

piece("population", "SELECT row, col, sum(value + 1) AS value FROM medium5 GROUP BY ALL")
piece("population_full", FULL.format(bins="population"))
disc("population_sum", "population_full")
piece("capacity_full", FULL.format(bins="bins"))
disc("capacity_sum", "capacity_full")
piece("crash_bins", "SELECT row, col, CAST(count(*) AS DOUBLE) AS value FROM medium7 GROUP BY ALL")
piece("crash_full", FULL.format(bins="crash_bins"))
disc("crash_sum", "crash_full")
piece("entry_bins", "SELECT row, col, sum(value * 9000) AS value FROM medium9 GROUP BY ALL")
piece("entry_full", FULL.format(bins="entry_bins"))
disc("entry_sum", "entry_full")
piece("exit_bins", "SELECT row, col, sum(value * 5000) AS value FROM medium9 GROUP BY ALL")
piece("exit_full", FULL.format(bins="exit_bins"))
disc("exit_sum", "exit_full")


def _medium_distance(name: str, source: str) -> None:
    piece(
        name,
        f"""
        SELECT g.row, g.col,
               sqrt(CAST(min((g.row - s.row) * (g.row - s.row)
                             + (g.col - s.col) * (g.col - s.col)) AS DOUBLE)) * 20 AS value
        FROM medium_grid g, (SELECT DISTINCT row, col FROM {source} JOIN borough_medium USING (row, col)) s GROUP BY ALL
        """,
    )


_medium_distance("complex_distance", "medium9")
_medium_distance("route_distance", "medium11")


def boroughs(spark, region=FINE) -> DataFrame:
    """Cells of the boroughs; a medium cell counts if its fine cell in the middle does."""
    inside = FINE.cells(spark).filter(f"NOT {OUTSIDE}")
    if region is FINE:
        return inside
    return g.resample_nearest(inside.withColumn("value", F.lit(1.0)), FINE, MEDIUM)


def fine_stations(spark, sf) -> DataFrame:
    return g.rasterize_points(points(spark, sf), None, FINE, "id")


def fine_streets(spark, sf) -> DataFrame:
    streets = g.rasterize_points(points(spark, sf, 3), "value", FINE, "id")
    return s.bikeable_streets(streets)


def allowed(spark, sf) -> DataFrame:
    return s.constraint(
        fine_stations(spark, sf), fine_streets(spark, sf), FINE, STATION_MIN, STATION_MAX, STREET_MAX,
        boroughs(spark),
    )


def served(spark, sf) -> DataFrame:
    return s.service_area(fine_stations(spark, sf), FINE, MEDIUM, RADIUS, boroughs(spark))


def active(spark, sf) -> DataFrame:
    return s.service_area_mask(served(spark, sf), MEDIUM.cells(spark))


def walk_sum(spark, sf, first: int, value: str | None = "value") -> DataFrame:
    binned = g.bin_sum(points(spark, sf, first), value, MEDIUM)
    return g.focal_sum(binned, RADIUS, MEDIUM, fill=True)


def population(spark, sf) -> DataFrame:
    people = points(spark, sf, 5).withColumn("value", F.col("value") + 1)
    return g.bin_sum(people, "value", MEDIUM, fill=True)


def population_sum(spark, sf) -> DataFrame:
    people = points(spark, sf, 5).withColumn("value", F.col("value") + 1)
    return g.focal_sum(g.bin_sum(people, "value", MEDIUM), RADIUS, MEDIUM, fill=True)


def riders(spark, sf, factor: int) -> DataFrame:
    counted = points(spark, sf, 9).withColumn("value", F.col("value") * factor)
    return g.focal_sum(g.bin_sum(counted, "value", MEDIUM), RADIUS, MEDIUM, fill=True)


def complex_distance(spark, sf) -> DataFrame:
    stops = g.mask(g.bin_sum(points(spark, sf, 9), None, MEDIUM), boroughs(spark, MEDIUM))
    return d.distance_to_nearest(stops, MEDIUM)


def route_distance(spark, sf) -> DataFrame:
    routes = g.mask(g.bin_sum(points(spark, sf, 11), None, MEDIUM), boroughs(spark, MEDIUM))
    return d.distance_to_nearest(routes, MEDIUM)


def share(spark, sf, first: int) -> DataFrame:
    """Share of empty stations by the nearest station."""
    rated = points(spark, sf, first).withColumn("value", F.col("value") / 20)
    return d.nearest_value(rated, "value", MEDIUM, "id")


for _first in (1, 3, 5, 7):
    piece(f"share{_first}", nearest_sql(f"medium{_first}", "s.value / 20"))
piece("docks_ratio", """
    SELECT row, col, least(c.value / p.value * 1000, 100) AS value
    FROM capacity_sum c JOIN population_sum p USING (row, col) WHERE p.value <> 0
""")


def docks(spark, sf) -> DataFrame:
    return s.docks_per_person(walk_sum(spark, sf, 1), population_sum(spark, sf))


# potential of the served cells, from what lies around them unserved
piece("unserved_people", "SELECT row, col, p.value * u.value AS value FROM population_full p JOIN unserved u USING (row, col)")
disc("unserved_people_sum", "unserved_people")
piece("unserved_area", "SELECT row, col, value * 400 AS value FROM unserved")
disc("unserved_area_sum", "unserved_area")
IN_ACTIVE = "WHERE (row, col) IN (SELECT (row, col) FROM active)"
piece("potential_people", f"SELECT * FROM unserved_people_sum {IN_ACTIVE}")
piece("potential_land", f"SELECT * FROM unserved_area_sum {IN_ACTIVE}")


def potential_people(spark, sf) -> DataFrame:
    return s.potential_population(
        population(spark, sf), served(spark, sf), RADIUS, MEDIUM, active(spark, sf)
    )


def potential_land(spark, sf) -> DataFrame:
    return s.potential_area(served(spark, sf), RADIUS, MEDIUM, active(spark, sf), 400)


@bind("constraint", sql("SELECT * FROM allowed"))
def constraint(spark, sf):
    return allowed(spark, sf)


@bind("bikeable_streets", sql("SELECT row, col, 1.0::DOUBLE AS value FROM bikeable_fine"))
def bikeable_streets(spark, sf):
    return fine_streets(spark, sf)


@bind("service_area", sql("SELECT * FROM served"))
def service_area(spark, sf):
    return served(spark, sf)


@bind("docks_per_person", sql("SELECT * FROM docks_ratio"))
def docks_per_person(spark, sf):
    return docks(spark, sf)


@bind("potential_population", sql("SELECT * FROM potential_people"))
def potential_population(spark, sf):
    return potential_people(spark, sf)


@bind("potential_area", sql("SELECT * FROM potential_land"))
def potential_area(spark, sf):
    return potential_land(spark, sf)


# --- indices; floats are compared to six places, powers differ in the last digits ---


def rounded(cells: DataFrame) -> DataFrame:
    return cells.withColumn("value", F.round("value", 6))


def six(statement: str) -> str:
    return f"SELECT row, col, round(value, 6) AS value FROM ({statement})"


def masked(name: str) -> str:
    return f"SELECT * FROM {name} {IN_ACTIVE}"


def combine(*terms: tuple[str, str]) -> str:
    """A sum of expressions over layers, each written in terms of its alias."""
    names = [f"l{i}" for i in range(len(terms))]
    total = " + ".join(text.replace("@", f"{n}.value") for n, (_, text) in zip(names, terms))
    joins = "".join(
        f" JOIN {layer} {n} USING (row, col)" if i else f"{layer} {n}"
        for i, (n, (layer, _)) in enumerate(zip(names, terms))
    )
    return f"SELECT row, col, {total} AS value FROM {joins}"


piece("entry_norm", norm(f"SELECT row, col, least(value, 300000) AS value FROM entry_sum {IN_ACTIVE}"))
piece("exit_norm", norm(f"SELECT row, col, least(value, 500000) AS value FROM exit_sum {IN_ACTIVE}"))
piece("inverse_norm", norm(
    f"SELECT row, col, pow(greatest(value, 100), -0.5::DOUBLE) * 10000 AS value FROM complex_distance {IN_ACTIVE}"
))
piece("transit", combine(("entry_norm", "@ * 0.25::DOUBLE + @ * 0.25::DOUBLE"), ("inverse_norm", "@ * 0.5::DOUBLE")))
piece("transit_exits", combine(
    ("entry_norm", "@ * 0.25::DOUBLE"), ("exit_norm", "@ * 0.25::DOUBLE"), ("inverse_norm", "@ * 0.5::DOUBLE")
))
piece("trips_norm", norm(masked("nearest")))
piece("population_norm", norm(masked("population_sum")))
piece("profit", combine(("trips_norm", "@ * 0.75::DOUBLE"), ("population_norm", "@ * 0.25::DOUBLE")))
piece("people_norm", norm("SELECT * FROM potential_people"))
piece("land_norm", norm("SELECT * FROM potential_land"))
piece("expansion", combine(("people_norm", "@ * 0.5::DOUBLE"), ("land_norm", "@ * 0.5::DOUBLE")))
piece("route_norm", norm(masked("route_distance")))
piece("crash_norm", norm(masked("crash_sum")))
piece("danger", combine(("route_norm", "@ * 0.5::DOUBLE"), ("crash_norm", "@ * 0.5::DOUBLE")))
piece("safety", f"SELECT row, col, 101 - value AS value FROM ({norm('SELECT * FROM danger')})")
piece("docks_norm", norm(masked("docks_ratio")))
for _first in (1, 3, 5, 7):
    piece(f"share{_first}_norm", norm(f"SELECT row, col, value * 100 AS value FROM share{_first} {IN_ACTIVE}"))
piece("service", combine(
    ("docks_norm", "(101 - @) * 0.4::DOUBLE"),
    ("population_norm", "@ * 0.1::DOUBLE"),
    *[(f"share{i}_norm", "@ * 0.125::DOUBLE") for i in (1, 3, 5, 7)],
))


def in_service(spark, sf, cells: DataFrame) -> DataFrame:
    return settle(g.mask(cells, active(spark, sf)))


def transit_layers(spark, sf) -> list[DataFrame]:
    layers = (riders(spark, sf, 9000), riders(spark, sf, 5000), complex_distance(spark, sf))
    here = settle(active(spark, sf))
    named = {str(i): g.mask(cells, here) for i, cells in enumerate(layers)}
    return list(settle_all(named).values())


@bind("transit_index", sql(six("SELECT * FROM transit")))
def transit_index(spark, sf):
    return rounded(s.transit_index(*transit_layers(spark, sf)))


@bind("transit_index_with_exits", sql(six("SELECT * FROM transit_exits")))
def transit_index_with_exits(spark, sf):
    return rounded(s.transit_index(*transit_layers(spark, sf), use_exits=True))


def trips_layer(spark, sf) -> DataFrame:
    return in_service(spark, sf, d.nearest_value(points(spark, sf), "value", MEDIUM, "id"))


@bind("profitability_index", sql(six("SELECT * FROM profit")))
def profitability_index(spark, sf):
    people = in_service(spark, sf, population_sum(spark, sf))
    return rounded(s.profitability_index(trips_layer(spark, sf), people))


@bind("expansion_index", sql(six("SELECT * FROM expansion")))
def expansion_index(spark, sf):
    people, land = settle(potential_people(spark, sf)), settle(potential_land(spark, sf))
    return rounded(s.expansion_index(people, land))


def danger(spark, sf) -> DataFrame:
    routes = in_service(spark, sf, route_distance(spark, sf))
    crashes = in_service(spark, sf, walk_sum(spark, sf, 7, None))
    return settle(s.danger_index(routes, crashes))


@bind("danger_index", sql(six("SELECT * FROM danger")))
def danger_index(spark, sf):
    return rounded(danger(spark, sf))


@bind("safety_index", sql(six("SELECT * FROM safety")))
def safety_index(spark, sf):
    return rounded(s.safety_index(danger(spark, sf)))


@bind("service_improvement_index", sql(six("SELECT * FROM service")))
def service_improvement_index(spark, sf):
    here = settle(active(spark, sf))
    layers = {"docks": docks(spark, sf), "people": population_sum(spark, sf)}
    layers |= {f"share{first}": share(spark, sf, first) for first in (1, 3, 5, 7)}
    docked, people, *shares = settle_all({n: g.mask(c, here) for n, c in layers.items()}).values()
    return rounded(s.service_improvement_index(docked, people, shares))


# --- scores, on five layers spread over the whole map ---

SCORED = {"service": "bin_discs", "transit": "entry_sum", "expansion": "population_sum",
          "profit": "crash_sum", "safety": "capacity_sum"}
for _name, _layer in SCORED.items():
    piece(f"{_name}_score", norm(f"SELECT m.row, m.col, coalesce(value, 0) AS value FROM medium_grid m LEFT JOIN {_layer} USING (row, col)"))


def score_layers(spark, sf) -> dict[str, DataFrame]:
    raw = {
        "service": g.focal_sum(bins(spark, sf), RADIUS, MEDIUM, fill=True),
        "transit": riders(spark, sf, 9000),
        "expansion": population_sum(spark, sf),
        "profit": walk_sum(spark, sf, 7, None),
        "safety": walk_sum(spark, sf, 1),
    }
    return {name: g.normalize(cells) for name, cells in settle_all(raw).items()}


def _weighted(shares: dict[str, float]) -> str:
    return combine(*[(f"{n}_score", f"@ * {w!r}::DOUBLE") for n, w in shares.items()])


piece("weighted", _weighted({n: w / 10 for n, w in WEIGHTS.items()}))
piece("score", norm("SELECT * FROM weighted"))
piece("weighted_legacy", _weighted({n: float(f"0.{w}") for n, w in {**WEIGHTS, "service": 10, "expansion": 4}.items()}))


@bind("suitability", sql(six("SELECT * FROM score")))
def suitability(spark, sf):
    return rounded(s.suitability(score_layers(spark, sf), WEIGHTS))


@bind("suitability_legacy", sql(six(norm("SELECT * FROM weighted_legacy"))))
def suitability_legacy(spark, sf):
    weights = {**WEIGHTS, "service": 10, "expansion": 4}
    return rounded(s.suitability(score_layers(spark, sf), weights, legacy=True))


piece(
    "score_allowed",
    """
    SELECT a.row, a.col, s.value * a.value AS value
    FROM allowed a JOIN score s ON s.row = a.row // 2 AND s.col = a.col // 2
    """,
)


@bind("suitability_constrained", sql(six(norm("SELECT * FROM score_allowed"))))
def suitability_constrained(spark, sf):
    score = settle(s.suitability(score_layers(spark, sf), WEIGHTS))
    return rounded(s.suitability_constrained(score, settle(allowed(spark, sf)), MEDIUM, FINE))


piece("preference", "SELECT row, col, CASE WHEN value > 3 THEN -50.0 ELSE 50.0 END::DOUBLE AS value FROM full_other")
piece(
    "preferred",
    """
    SELECT row, col, greatest(s.value + 0.6::DOUBLE * p.value, 0) AS value
    FROM score s JOIN preference p USING (row, col)
    """,
)


@bind("apply_preference", sql(six(norm("SELECT * FROM preferred"))))
def apply_preference(spark, sf):
    score = settle(s.suitability(score_layers(spark, sf), WEIGHTS))
    preference = full_bins(spark, sf, 3).withColumn(
        "value", F.when(F.col("value") > 3, -50.0).otherwise(50.0)
    )
    return rounded(s.apply_preference(score, settle(preference), 60))


piece("wish_codes", "SELECT row, col, max(value % 3) AS code FROM covered GROUP BY ALL")


@bind(
    "preference_layer",
    sql("SELECT row, col, CASE code WHEN 0 THEN -50.0 ELSE 50.0 END::DOUBLE AS value FROM wish_codes WHERE code <> 1"),
)
def preference_layer(spark, sf):
    """Triangles in three kinds: one disliked, one without a wish, one preferred."""
    areas = lines(spark, sf).withColumn("boro_code", (F.col("value") % 3).cast("int"))
    return s.preference_layer(areas, {0: -50, 2: 50}, MEDIUM)


# the whole model: five indices from the layers of the service area, then the score;
# an even layer of shares weighs as 1, and halving a layer does not change its scale
piece("even_share", "SELECT row, col, 1.0::DOUBLE AS value FROM active")
piece("model_service", combine(
    ("docks_norm", "(101 - @) * 0.4::DOUBLE"),
    ("population_norm", "@ * 0.1::DOUBLE"),
    ("share1_norm", "@ * 0.125::DOUBLE"),
    ("share3_norm", "@ * 0.125::DOUBLE"),
    ("even_share", "@ * 0.125::DOUBLE"),
    ("share3_norm", "@ * 0.125::DOUBLE"),
))
piece("model", combine(*[
    (f"({norm(f'SELECT * FROM {layer}')})" if name != "safety" else layer, f"@ * {WEIGHTS[name] / 10!r}::DOUBLE")
    for name, layer in (("service", "model_service"), ("transit", "transit"), ("expansion", "expansion"),
                        ("profit", "profit"), ("safety", "safety"))
]))


@bind("siting_pipeline", sql(six(norm("SELECT * FROM model"))))
def siting_pipeline(spark, sf):
    area = settle(served(spark, sf))
    here = settle(s.service_area_mask(area, MEDIUM.cells(spark)))
    value = F.col("value")

    def rated(first: int, **columns) -> DataFrame:
        return points(spark, sf, first).withColumns(columns)

    layers = s.service_layers(
        docks=rated(1, capacity=value),
        population=population(spark, sf),
        crashes=rated(7, number_of_cyclist_injured=F.lit(1.0)),
        complexes=rated(
            9,
            mean_daily_entries_2023=value * 9000,
            mean_daily_exits_2023=value * 5000,
            total_exits_all=F.lit(1.0),
        ),
        routes=g.bin_sum(points(spark, sf, 11), None, MEDIUM),
        peak=rated(1, bikes_available_eq0=value / 20, docks_available_eq0=F.lit(0.5)),
        offpeak=rated(3, bikes_available_eq0=value / 20, docks_available_eq0=value / 40),
        trips=rated(1, trips_per_day_per_dock=value),
        area=area,
        active=here,
        region=MEDIUM,
        radius=RADIUS,
        cell_area=400,
        boroughs=boroughs(spark, MEDIUM),
    )
    return rounded(s.suitability(s.index_layers(layers), WEIGHTS))
