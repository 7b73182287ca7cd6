"""Siting model: constraint, service area, five indices and the weighted score."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockwise.operators.clean import (
    MIN_TRACT_AREA,
    filter_slivers,
    fix_capacity_typo,
    population_per_cell,
)
from dockwise.operators.distance import distance_to_nearest, nearest_values
from dockwise.operators.grid import (
    CELL,
    MEDIUM_CELL_AREA,
    MEDIUM_RES,
    Region,
    bin_sum,
    burn_categories,
    cap,
    cell_algebra,
    cells_within,
    fill_empty,
    fill_within,
    focal_sum,
    inverse_distance,
    mask,
    normalize,
    null_if,
    rasterize_points,
    reclass_codes,
    reclass_distance,
    reclass_invert,
    resample_nearest,
)
from dockwise.operators.vector import polygon_cells, rasterize_lines
from dockwise.session import settle, settle_all

# Distances in feet, ceilings of layers and weights of indices.
WALK_RADIUS = 2640
STREET_MAX = 60
STATION_MIN = 100
DOCKS_PER_PERSON_SCALE = 1000
DOCKS_PER_PERSON_CAP = 100
ENTRIES_CAP = 300000
EXITS_CAP = 500000
TRANSIT_WEIGHTS = (0.25, 0.25, 0.50)
PROFITABILITY_WEIGHTS = (0.75, 0.25)
EXPANSION_WEIGHTS = (0.5, 0.5)
DANGER_WEIGHTS = (0.5, 0.5)
SERVICE_WEIGHTS = (0.4, 0.10, 0.125)
# The columns the point layers carry.
LAYER_COLUMNS = {
    "entries": "mean_daily_entries_2023",
    "exits": "mean_daily_exits_2023",
    "total_exits": "total_exits_all",
    "trips": "trips_per_day_per_dock",
    "injured": "number_of_cyclist_injured",
    "capacity": "capacity",
    "bikes": "bikes_available_eq0",
    "docks": "docks_available_eq0",
}
BIKEABLE_STREETS = (1, 3, 5, 6, 7, 10, 11, 13)
OTHER_STREETS = (2, 4, 8, 9, 12, 14)
INDICES = ("service", "transit", "expansion", "profit", "safety")


def population_cells(
    tracts: DataFrame,
    boundary: DataFrame,
    region: Region,
    key: str = "tract",
    population: str = "population",
    min_area: float = MIN_TRACT_AREA,
) -> DataFrame:
    """People per cell: each tract's population spread over its cells inside the boundary.

    Tracts of which only a sliver lies inside are left out.
    """
    inside = cells_within(polygon_cells(tracts, region, [key, population]), boundary)
    cell_area = float(region.res) ** 2
    areas = inside.groupBy(key).agg((F.count(F.lit(1)) * F.lit(cell_area)).alias("area"))
    spread = inside.join(filter_slivers(areas, min_area=min_area), key)
    held = population_per_cell(spread, cell_area, population)
    return held.groupBy(*CELL).agg(F.max_by("pop_per_area", key).alias("value"))


def bikeable_streets(streets: DataFrame) -> DataFrame:
    """Street cells by type code, highways, bridges and tunnels left out."""
    return reclass_codes(streets, {1: BIKEABLE_STREETS, None: OTHER_STREETS})


def near(sources: DataFrame, region: Region, lo: int, hi: int) -> DataFrame:
    """1 and 0 by distance band; cells beyond the band have no row and count as 0."""
    return reclass_distance(distance_to_nearest(sources, region, max_dist=hi + 1), lo, hi)


def constraint(
    stations: DataFrame,
    streets: DataFrame,
    region: Region,
    lo: int = STATION_MIN,
    hi: int = WALK_RADIUS,
    street_max: int = STREET_MAX,
    boroughs: DataFrame | None = None,
) -> DataFrame:
    """1 where a dock may stand: by a bikeable street, off other docks but within a walk.

    With `boroughs` (cells of the region) only sources inside count, and cells
    outside stay empty.
    """
    by_station = near(_inside(stations, boroughs), region, lo, hi)
    by_street = near(_inside(streets, boroughs), region, 0, street_max)
    both = cell_algebra("stations * streets", stations=by_station, streets=by_street)
    return fill_empty(both, region) if boroughs is None else fill_within(both, boroughs)


def _inside(cells: DataFrame, boroughs: DataFrame | None) -> DataFrame:
    return cells if boroughs is None else mask(cells, boroughs)


def service_area(
    stations: DataFrame,
    fine: Region,
    medium: Region,
    radius: int = WALK_RADIUS,
    boroughs: DataFrame | None = None,
) -> DataFrame:
    """1 within a walk of a station and 0 elsewhere, found fine and kept medium.

    With `boroughs` (fine cells) only stations inside count, and cells outside
    stay empty: they are no land that waits to be served.
    """
    walk = near(_inside(stations, boroughs), fine, 0, radius)
    if boroughs is None:
        return fill_empty(resample_nearest(walk, fine, medium), medium)
    return resample_nearest(fill_within(walk, boroughs), fine, medium)


def service_area_mask(area: DataFrame, boroughs: DataFrame) -> DataFrame:
    """The served cells inside the boroughs."""
    return null_if(mask(area, boroughs), 0)


def docks_per_person(
    capacity_sum: DataFrame,
    population_sum: DataFrame,
    scale: float = DOCKS_PER_PERSON_SCALE,
    limit: float = DOCKS_PER_PERSON_CAP,
) -> DataFrame:
    """Docks over people within a walk, scaled and capped; empty where nobody lives."""
    ratio = cell_algebra(
        "try_divide(docks, people)", docks=capacity_sum, people=population_sum
    )
    return cap(cell_algebra(f"ratio * {float(scale)}D", ratio=ratio), limit)


def potential_population(
    population: DataFrame, area: DataFrame, radius: float, region: Region, active: DataFrame
) -> DataFrame:
    """People within a walk of a served cell who are not served themselves."""
    unserved = cell_algebra(
        "people * inverse", people=population, inverse=reclass_invert(area)
    )
    return mask(focal_sum(unserved, radius, region, fill=True), active)


def potential_area(
    area: DataFrame,
    radius: float,
    region: Region,
    active: DataFrame,
    cell_area: float = MEDIUM_CELL_AREA,
) -> DataFrame:
    """Area within a walk of a served cell that is not served itself."""
    unserved = cell_algebra(f"inverse * {float(cell_area)}D", inverse=reclass_invert(area))
    return mask(focal_sum(unserved, radius, region), active)


def weighted(weights: Sequence[float], *layers: DataFrame) -> DataFrame:
    """Weighted sum of aligned layers, empty where any layer is."""
    named = {f"layer{i}": layer for i, layer in enumerate(layers)}
    terms = [f"{name} * {float(w)}D" for name, w in zip(named, weights, strict=True)]
    return cell_algebra(" + ".join(terms), **named)


def transit_index(
    entries: DataFrame,
    exits: DataFrame,
    distance: DataFrame,
    weights: Sequence[float] = TRANSIT_WEIGHTS,
    use_exits: bool = False,
    floor: float = MEDIUM_RES,
) -> DataFrame:
    """Riders within a walk and closeness to a complex.

    The second weight falls on entries again, as users know the index; with
    `use_exits` it falls on exits.
    """
    riders = normalize(cap(entries, ENTRIES_CAP))
    others = normalize(cap(exits, EXITS_CAP)) if use_exits else riders
    closeness = normalize(inverse_distance(distance, floor))
    if use_exits:
        return weighted(weights, riders, others, closeness)
    first, second, third = weights
    named = {"riders": riders, "closeness": closeness}
    return cell_algebra(
        f"riders * {first}D + riders * {second}D + closeness * {third}D", **named
    )


def profitability_index(
    trips: DataFrame, population_sum: DataFrame, weights: Sequence[float] = PROFITABILITY_WEIGHTS
) -> DataFrame:
    """Trips per dock and day of the nearest station, and people within a walk."""
    return weighted(weights, normalize(trips), normalize(population_sum))


def expansion_index(
    population: DataFrame, area: DataFrame, weights: Sequence[float] = EXPANSION_WEIGHTS
) -> DataFrame:
    """Unserved people and unserved area within a walk."""
    return weighted(weights, normalize(population), normalize(area))


def danger_index(
    route_distance: DataFrame, crashes: DataFrame, weights: Sequence[float] = DANGER_WEIGHTS
) -> DataFrame:
    """Distance from bike routes and crashes within a walk."""
    return weighted(weights, normalize(route_distance), normalize(crashes))


def safety_index(danger: DataFrame) -> DataFrame:
    """101 less the normalised danger, so that high is good."""
    return cell_algebra("101D - danger", danger=normalize(danger))


def service_improvement_index(
    docks: DataFrame,
    population_sum: DataFrame,
    shares: Sequence[DataFrame],
    weights: Sequence[float] = SERVICE_WEIGHTS,
) -> DataFrame:
    """Few docks per person, many people, and stations often empty or full.

    `shares` are the four layers of empty and full shares, peak and off peak.
    """
    few, people, share = weights
    named = {f"share{i}": normalize(_percent(layer)) for i, layer in enumerate(shares)}
    often = " + ".join(f"{name} * {share}D" for name in named)
    return cell_algebra(
        f"(101D - docks) * {few}D + people * {people}D + {often}",
        docks=normalize(docks),
        people=normalize(population_sum),
        **named,
    )


def _percent(layer: DataFrame) -> DataFrame:
    return layer.selectExpr("row", "col", "value * 100D AS value")


def weight_shares(weights: Mapping[str, float], legacy: bool = False) -> dict[str, float]:
    """The five weights as shares of their sum.

    `legacy` writes each weight behind a decimal point instead, as `0.<w>`,
    which takes 10 for less than 2.
    """
    missing = [name for name in INDICES if name not in weights]
    if missing:
        raise ValueError(f"all five weights are needed, missing: {', '.join(missing)}")
    if sum(weights[n] for n in INDICES) % 10 != 0:
        raise ValueError("the weights must be whole and add up to a multiple of 10")
    if legacy:
        return {n: float(f"0.{weights[n]}") for n in INDICES}
    total = sum(weights[n] for n in INDICES)
    return {n: weights[n] / total for n in INDICES}


def suitability(
    indices: Mapping[str, DataFrame], weights: Mapping[str, float], legacy: bool = False
) -> DataFrame:
    """Weighted sum of the five normalised indices, normalised again."""
    shares = weight_shares(weights, legacy)
    return normalize(weighted(list(shares.values()), *[indices[n] for n in shares]))


def suitability_constrained(
    score: DataFrame, allowed: DataFrame, src: Region, dst: Region
) -> DataFrame:
    """Score where a dock may stand, at the fine resolution, normalised."""
    fine = resample_nearest(score, src, dst)
    return normalize(cell_algebra("score * allowed", score=fine, allowed=allowed))


def apply_preference(score: DataFrame, preference: DataFrame, weight: float = 100) -> DataFrame:
    """Score moved by a preference layer, no lower than 0, normalised."""
    share = float(weight) / 100.0
    moved = f"score + {share}D * preference"
    floored = f"CASE WHEN {moved} <= 0 THEN 0D ELSE {moved} END"
    return normalize(cell_algebra(floored, score=score, preference=preference))


def preference_layer(
    areas: DataFrame,
    wishes: Mapping[object, float],
    region: Region,
    code: str = "boro_code",
    parts: str = "parts",
) -> DataFrame:
    """Preference by area code on the cells of polygons; areas without a wish stay empty.

    Where areas of several codes hold a cell, the largest code counts.
    """
    held = polygon_cells(areas, region, [code], parts).groupBy(*CELL).agg(F.max(code).alias("_code"))
    burnt = burn_categories(held, list(wishes.items()), category="_code")
    return burnt.filter(F.col("value").isNotNull())


def siting_from_vectors(
    boroughs: DataFrame,
    streets: DataFrame,
    routes: DataFrame,
    tracts: DataFrame,
    docks: DataFrame,
    complexes: DataFrame,
    crashes: DataFrame,
    peak: DataFrame,
    offpeak: DataFrame,
    trips: DataFrame,
    fine: Region,
    medium: Region,
    weights: Mapping[str, float],
    wishes: Mapping[object, float] | None = None,
    wish_weight: float = 100,
    radius: int = WALK_RADIUS,
    station_min: int = STATION_MIN,
    street_max: int = STREET_MAX,
    key: str = "id",
    street_type: str = "rw_type",
    borough_code: str = "boro_code",
    names: Mapping[str, str] = LAYER_COLUMNS,
    min_tract_area: float = MIN_TRACT_AREA,
) -> dict[str, DataFrame]:
    """The whole model from vector layers: constraint, service area, score, constrained score.

    `boroughs` and `tracts` are polygons, `streets` and `routes` lines, the rest points;
    lines and points carry a key. With `wishes`, a preference by borough code, both scores
    come out moved by it as well. All layers returned are settled.
    """
    land = polygon_cells(boroughs, fine, [borough_code]).select(*CELL).distinct()
    medium_land = polygon_cells(boroughs, medium, [borough_code]).select(*CELL).distinct()
    base = settle_all(
        {
            "land": land,
            "medium_land": medium_land,
            "stations": rasterize_points(docks, None, fine, key),
            "streets": bikeable_streets(rasterize_lines(streets, street_type, fine, key)),
            "routes": rasterize_lines(routes, None, medium, key),
        }
    )
    result = settle_all(
        {
            "constraint": constraint(
                base["stations"], base["streets"], fine, station_min, radius, street_max, base["land"]
            ),
            "service_area": service_area(base["stations"], fine, medium, radius, base["land"]),
        }
    )
    area = result["service_area"]
    layers = service_layers(
        docks=docks,
        population=population_cells(tracts, base["medium_land"], medium, key=key, min_area=min_tract_area),
        crashes=crashes,
        complexes=complexes,
        routes=base["routes"],
        peak=peak,
        offpeak=offpeak,
        trips=trips,
        area=area,
        active=settle(service_area_mask(area, base["medium_land"])),
        region=medium,
        radius=radius,
        cell_area=float(medium.res) ** 2,
        key=key,
        names=names,
        boroughs=base["medium_land"],
    )
    result["suitability"] = settle(suitability(index_layers(layers), weights))
    result["suitability_constrained"] = settle(
        suitability_constrained(result["suitability"], result["constraint"], medium, fine)
    )
    if wishes:
        for name, region in (("suitability", medium), ("suitability_constrained", fine)):
            wish = settle(preference_layer(boroughs, wishes, region, borough_code))
            result[f"{name}_preferred"] = settle(apply_preference(result[name], wish, wish_weight))
    return result


def service_layers(
    docks: DataFrame,
    population: DataFrame,
    crashes: DataFrame,
    complexes: DataFrame,
    routes: DataFrame,
    peak: DataFrame,
    offpeak: DataFrame,
    trips: DataFrame,
    area: DataFrame,
    active: DataFrame,
    region: Region,
    radius: float = WALK_RADIUS,
    cell_area: float = MEDIUM_CELL_AREA,
    key: str = "id",
    names: Mapping[str, str] = LAYER_COLUMNS,
    boroughs: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """The layers of the served cells that the indices are made of.

    `population` and `routes` are cells; the others are points with x, y, a
    key and the columns of `names`. `area` and `active` should be settled.
    With `boroughs` (cells of the region) routes and stops outside are no
    sources of distance.
    """

    def walk_sum(points: DataFrame, value: str) -> DataFrame:
        return focal_sum(bin_sum(points, names[value], region), radius, region, fill=True)

    def by_nearest(points: DataFrame, *values: str) -> list[DataFrame]:
        """Layers of several values of one point layer, found in one pass."""
        found = settle(mask(nearest_values(points, [names[v] for v in values], region, key), active))
        return [found.select(*CELL, F.col(names[v]).alias("value")) for v in values]

    people = settle(population)
    people_sum = focal_sum(people, radius, region, fill=True)
    stops = null_if(rasterize_points(complexes, names["total_exits"], region, key), 0)
    peak_bikes, peak_docks = by_nearest(peak, "bikes", "docks")
    offpeak_bikes, offpeak_docks = by_nearest(offpeak, "bikes", "docks")
    (trips_layer,) = by_nearest(fix_capacity_typo(trips, names["trips"]), "trips")
    layers = {
        "entries": walk_sum(complexes, "entries"),
        "exits": walk_sum(complexes, "exits"),
        "transit_distance": distance_to_nearest(_inside(stops, boroughs), region),
        "population_sum": people_sum,
        "route_distance": distance_to_nearest(_inside(routes, boroughs), region),
        "crashes": walk_sum(crashes, "injured"),
        "docks_per_person": docks_per_person(walk_sum(docks, "capacity"), people_sum),
    }
    return {
        **{name: mask(cells, active) for name, cells in layers.items()},
        "trips": trips_layer,
        "peak_bikes": peak_bikes,
        "peak_docks": peak_docks,
        "offpeak_bikes": offpeak_bikes,
        "offpeak_docks": offpeak_docks,
        "potential_population": potential_population(people, area, radius, region, active),
        "potential_area": potential_area(area, radius, region, active, cell_area),
    }


def index_layers(layers: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The five normalised indices from the settled layers of the service area.

    Expects entries, exits, transit_distance, trips, population_sum,
    potential_population, potential_area, route_distance, crashes,
    docks_per_person and the four shares peak_bikes, offpeak_bikes, peak_docks
    and offpeak_docks.
    """
    shares = ("peak_bikes", "offpeak_bikes", "peak_docks", "offpeak_docks")
    held = settle_all(layers)
    raw = settle_all(
        {
            "transit": transit_index(held["entries"], held["exits"], held["transit_distance"]),
            "profit": profitability_index(held["trips"], held["population_sum"]),
            "expansion": expansion_index(held["potential_population"], held["potential_area"]),
            "danger": danger_index(held["route_distance"], held["crashes"]),
            "service": service_improvement_index(
                held["docks_per_person"], held["population_sum"], [held[s] for s in shares]
            ),
        }
    )
    safety = safety_index(raw.pop("danger"))
    return settle_all({**{name: normalize(cells) for name, cells in raw.items()}, "safety": safety})
