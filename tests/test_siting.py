"""Weights, constraint and preference."""

import numpy as np
import pytest
from test_grid import array_of, brute_distance, cells_of, sparse

from dockwise.operators import grid as g
from dockwise.plans import siting as s

FINE = g.Region(0.0, 0.0, 10.0, 40, 40)
MEDIUM = g.Region(0.0, 0.0, 20.0, 20, 20)


def test_weights():
    weights = {"service": 10, "transit": 2, "expansion": 2, "profit": 2, "safety": 4}
    assert s.weight_shares(weights)["service"] == 0.5
    # written behind a decimal point, 10 weighs less than 2
    assert s.weight_shares(weights, legacy=True) == {
        "service": 0.1, "transit": 0.2, "expansion": 0.2, "profit": 0.2, "safety": 0.4,
    }
    with pytest.raises(ValueError, match="multiple of 10"):
        s.weight_shares({**weights, "safety": 5})
    with pytest.raises(ValueError, match="safety"):
        s.weight_shares({k: w for k, w in weights.items() if k != "safety"})


def test_constraint(spark):
    docks, streets = sparse(1, 0.005, FINE), sparse(2, 0.02, FINE)
    docks[3, 3] = streets[20, 20] = 1.0
    got = array_of(s.constraint(cells_of(spark, docks), cells_of(spark, streets), FINE, 30, 120, 25), FINE)
    by_dock, by_street = np.floor(brute_distance(docks, FINE)), np.floor(brute_distance(streets, FINE))
    want = (by_dock >= 30) & (by_dock <= 120) & (by_street <= 24)
    np.testing.assert_array_equal(got, want.astype(float))
    assert 0 < want.sum() < want.size


def test_service_area(spark):
    docks = sparse(3, 0.003, FINE)
    docks[10, 10] = 1.0
    got = array_of(s.service_area(cells_of(spark, docks), FINE, MEDIUM, 60), MEDIUM)
    inside = np.floor(brute_distance(docks, FINE)) <= 59
    np.testing.assert_array_equal(got, inside[1::2, 1::2].astype(float))


def test_preference_floors_at_zero(spark):
    score = spark.createDataFrame([(0, 0, 10.0), (0, 1, 60.0), (0, 2, 30.0)], "row int, col int, value double")
    wish = spark.createDataFrame([(0, 0, -50.0), (0, 1, 50.0), (0, 3, 1.0)], "row int, col int, value double")
    got = {r.col: r.value for r in s.apply_preference(score, wish, 50).collect()}
    assert got == {0: 1.0, 1: 100.0}


def test_docks_per_person(spark):
    docks = spark.createDataFrame([(0, 0, 5.0), (0, 1, 5.0), (0, 2, 5.0)], "row int, col int, value double")
    people = spark.createDataFrame([(0, 0, 1000.0), (0, 1, 0.0), (0, 2, 1.0)], "row int, col int, value double")
    got = {r.col: r.value for r in s.docks_per_person(docks, people).collect()}
    assert got == {0: 5.0, 2: 100.0}


def test_transit_index_counts_entries_twice(spark):
    schema = "row int, col int, value double"
    entries = spark.createDataFrame([(0, 0, 0.0), (0, 1, 400000.0)], schema)
    exits = spark.createDataFrame([(0, 0, 9.0), (0, 1, 1.0)], schema)
    far = spark.createDataFrame([(0, 0, 0.0), (0, 1, 400.0)], schema)
    got = {r.col: r.value for r in s.transit_index(entries, exits, far).collect()}
    assert got == {0: 50.5, 1: 50.5}
    fair = {r.col: r.value for r in s.transit_index(entries, exits, far, use_exits=True).collect()}
    assert fair == {0: 0.25 + 25 + 50, 1: 25 + 0.25 + 0.5}


def test_whole_model(spark):
    """Every index runs from 1 to 100 over the same cells."""
    names = ["entries", "exits", "transit_distance", "trips", "population_sum", "potential_population",
             "potential_area", "route_distance", "crashes", "docks_per_person", "peak_bikes",
             "offpeak_bikes", "peak_docks", "offpeak_docks"]
    rng = np.random.default_rng(1)
    layers = {n: cells_of(spark, rng.uniform(0, 50, (20, 20))) for n in names}
    indices = s.index_layers(layers)
    assert set(indices) == set(s.INDICES)
    for cells in indices.values():
        got = array_of(cells, MEDIUM)
        assert not np.isnan(got).any()
        np.testing.assert_allclose([got.min(), got.max()], [1, 100])
    score = s.suitability(indices, {n: 2 for n in s.INDICES})
    got = array_of(score, MEDIUM)
    np.testing.assert_allclose([got.min(), got.max()], [1, 100])


def test_boroughs_bound_the_service_area(spark):
    """Outside the boroughs nothing is a source, nothing is served and nothing waits to be served."""
    docks = sparse(3, 0.003, FINE)
    docks[10, 10] = docks[5, 38] = 1.0
    inside = np.zeros((40, 40), dtype=bool)
    inside[:, :30] = True
    boroughs = cells_of(spark, np.where(inside, 1.0, np.nan))
    area = s.service_area(cells_of(spark, docks), FINE, MEDIUM, 60, boroughs)
    kept = np.where(inside, docks, np.nan)
    want = (np.floor(brute_distance(kept, FINE)) <= 59).astype(float)
    want[~inside] = np.nan
    np.testing.assert_array_equal(array_of(area, MEDIUM), want[1::2, 1::2])
    unserved = array_of(g.reclass_invert(area), MEDIUM)
    assert np.isnan(unserved[:, 15:]).all()
    streets = sparse(2, 0.02, FINE)
    streets[20, 20] = 1.0
    allowed = array_of(s.constraint(cells_of(spark, docks), cells_of(spark, streets), FINE, 30, 120, 25, boroughs), FINE)
    assert np.isnan(allowed[~inside]).all() and not np.isnan(allowed[inside]).any()
    by_dock, by_street = np.floor(brute_distance(kept, FINE)), np.floor(brute_distance(np.where(inside, streets, np.nan), FINE))
    np.testing.assert_array_equal(
        allowed[inside], ((by_dock >= 30) & (by_dock <= 120) & (by_street <= 24))[inside].astype(float)
    )


def test_model_from_vector_layers(spark, tmp_path):
    """Layers on disk to both scores and both preferred scores; parts checked by hand."""
    from dockwise.plans import datasets as b
    from dockwise.sources.files import scan_layer, scan_raster
    from dockwise.sources.tables import write_layer

    root = str(tmp_path / "layers")
    rng = np.random.default_rng(3)

    def square(x, y, side):
        corners = [(x, y), (x + side, y), (x + side, y + side), (x, y + side)]
        return [[[{"x": float(a), "y": float(c)} for a, c in corners]]]

    def put(name, rows_, schema):
        write_layer(spark.createDataFrame(rows_, schema), root, name)

    parts = "parts array<array<array<struct<x:double,y:double>>>>"
    paths = "paths array<array<struct<x:double,y:double>>>"
    # two boroughs on the west 300 ft of a map of 400 ft; the rest is water
    put("boroughs", [("1", square(0, 0, 150)), ("1", square(0, 150, 250)), ("3", square(150, 0, 150))], f"boro_code string, {parts}")
    put("acs", [("a", 500, square(0, 0, 300)), ("b", 90, square(0, 300, 100))], f"tract string, population int, {parts}")
    line = [[{"x": 5.0, "y": 55.0}, {"x": 395.0, "y": 55.0}]]
    put("streets", [("1", line), ("2", [[{"x": 5.0, "y": 155.0}, {"x": 395.0, "y": 155.0}]])], f"rw_type string, {paths}")
    put("routes", [("r", line)], f"name string, {paths}")
    docks = [(f"s{i}", float(x), float(y), 20 + i) for i, (x, y) in enumerate(rng.uniform(10, 140, (5, 2)))]
    docks.append(("far", 390.0, 50.0, 9))  # on the water, no source of a walk
    put("station", docks, "station_id string, x double, y double, capacity int")
    put("annual_by_year", [("all", f"c{i}", 50.0 + 60 * i, 60.0, 1000.0 * i, 900.0, 5.0) for i in range(3)],
        "period string, complex_id string, x double, y double, mean_daily_entries_2023 double, mean_daily_exits_2023 double, total_exits_all double")
    put("motor_vehicle_crashes", [(float(x), 70.0, 1.0) for x in range(20, 200, 30)], "x double, y double, number_of_cyclist_injured double")
    put("status_summary", [(p, k, x, y, 0.1 * i, 0.05 * i) for p in ("peak", "offpeak") for i, (k, x, y, _) in enumerate(docks)],
        "period string, station_id string, x double, y double, bikes_available_eq0 double, docks_available_eq0 double")
    put("trips_summary", [(k, x, y, 1.0 + i) for i, (k, x, y, _) in enumerate(docks)],
        "station_id string, x double, y double, trips_per_day_per_dock double")

    made = b.build_siting(
        spark, root, FINE, MEDIUM, {n: 2 for n in s.INDICES}, {"1": -50, "3": 50}, 60,
        radius=60, station_min=10, street_max=30, min_tract_area=0,
    )
    assert made == ["constraint", "service_area", "suitability", "suitability_constrained",
                    "suitability_preferred", "suitability_constrained_preferred"]
    got = {n: array_of(scan_raster(spark, f"{root}/{n}"), FINE if "constr" in n else MEDIUM) for n in made}

    land = np.zeros((40, 40), dtype=bool)
    land[:15, :30] = land[15:40, :25] = True
    at = np.full((40, 40), np.nan)
    for _, x, y, _ in docks[:-1]:
        at[int(y // 10), int(x // 10)] = 1.0
    by_dock = np.floor(brute_distance(at, FINE))
    street = np.full((40, 40), np.nan)
    street[5, :30] = 1.0  # the bikeable one, as far as there is land
    by_street = np.floor(brute_distance(street, FINE))
    allowed = ((by_dock >= 10) & (by_dock <= 60) & (by_street <= 29)).astype(float)
    np.testing.assert_array_equal(got["constraint"], np.where(land, allowed, np.nan))
    served = np.where(land, (by_dock <= 59).astype(float), np.nan)[1::2, 1::2]
    np.testing.assert_array_equal(got["service_area"], served)
    scored = ~np.isnan(got["suitability"])
    assert scored.any() and (served[scored] == 1).all()
    np.testing.assert_allclose([np.nanmin(got["suitability"]), np.nanmax(got["suitability"])], [1, 100])
    wish = np.full((20, 20), np.nan)
    wish[:, :] = np.where(land[1::2, 1::2], -50.0, np.nan)
    wish[:7, 8:15] = 50.0
    wish[:8, 7] = np.nan  # the border of the boroughs is left to the rasteriser
    wish[7, :] = np.nan
    moved = np.maximum(got["suitability"] + 0.6 * wish, 0)
    ours = got["suitability_preferred"]
    both = ~np.isnan(moved) & ~np.isnan(ours)
    order = np.argsort(moved[both], kind="stable")
    assert both.any() and (np.diff(ours[both][order]) >= -1e-9).all()  # one scale, so one order
    fine = got["suitability_constrained"]
    assert ((~np.isnan(fine)) == (np.kron(scored, np.ones((2, 2), dtype=bool)) & ~np.isnan(got["constraint"]))).all()
    assert scan_layer(spark, root, "suitability").count() > 0
