"""Embedding near-duplicates against brute force."""

import math
import os
import random
import threading

import numpy as np
import pandas as pd
import pytest

from dockwise.llm import embeddings as e
from dockwise.llm.embeddings import MultiIndex, near_vectors, op7_embeddings
from dockwise.session import shared_root


def brute(rows, threshold=0.98):
    """n_links and component of every row, by all pairs of a label."""
    unit = {}
    for k, (_, v, label) in enumerate(rows):
        ok = label is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v)
        if ok:
            x = np.asarray(v, dtype="<f4").astype(float)
            unit[k] = x / np.linalg.norm(x)
    links = [0] * len(rows)
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in unit:
        for b in unit:
            if a != b and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= threshold:
                links[a] += 1
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    out = []
    for k, (i, _, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(k) and rows[j][0] is not None]
        low = min(ids) if ids else None
        out.append((i, links[k], low, i == low))
    return sorted(out, key=str)


def made(rng, n, dim):
    rows = []
    for _ in range(n):
        base = rng.normal(size=dim)
        for _ in range(rng.integers(1, 6)):
            rows.append(base + rng.normal(size=dim) * rng.choice([0.0, 0.01, 0.02, 0.06]) * np.linalg.norm(base) / dim**0.5 * 3)
    return [(int(i) * 3, [float(np.float32(c)) for c in v], int(i) % 3) for i, v in enumerate(rows)]


def check(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, node string")
    got = near_vectors(df, **options)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)


ODD = [
    (900, None, 1), (901, [], 1), (902, [0.0] * 16, 1), (903, [None] + [1.0] * 15, 1), (904, [float("nan")] * 16, 1),
    (905, [float("inf")] * 16, 1), (906, [1.0] * 16, None), (907, [1.0] * 16, None), (908, [1.0] * 16, 1),
    (909, [2.0] * 16, 1), (910, [1e-30] * 16, 1), (911, [1e30] * 16, 1), (912, [-1.0] * 16, 1), (913, [1.0, 1.0], 1),
    (914, [3.0, 3.0], 1), (None, [1.0] * 16, 1), (None, [5.0] + [0.0] * 15, 2), (908, [1.0] * 16, 1), (915, [4.0], 1), (916, [9.0], 1),
]


def test_all_pairs(spark):
    check(spark, made(np.random.default_rng(3), 60, 16) + ODD)


def test_cells_in_blocks(spark, monkeypatch):
    """Cells are cut into pieces that meet in tasks of their own; no pair is lost or counted twice."""
    rng = np.random.default_rng(4)
    base = rng.normal(size=16)
    tight = [(i, [float(np.float32(c)) for c in base + rng.normal(size=16) * 0.05], 0) for i in range(150)]
    tight += [(i, tight[0][1], 0) for i in range(150, 190)]
    full = e.link_vectors
    monkeypatch.setattr(e, "link_vectors", lambda v, index, t: full(v, index, t, block=16))
    check(spark, tight)


def test_traversal_is_in_order_and_whole():
    rng = random.Random(2)
    index = MultiIndex(np.zeros((5, 2)), np.zeros((7, 2)), 0.0)
    for _ in range(50):
        first, second = (np.array([0.0] + [rng.choice([0.1, 0.2, rng.random()]) for _ in range(n - 1)]) for n in (5, 7))
        index.stop = rng.random()
        want = {i * 7 + j for i in range(5) for j in range(7) if first[i] ** 2 + second[j] ** 2 <= index.stop**2}
        got = index.visits(first, second)
        assert set(got) == want and len(got) == len(want)
        far = [first[c // 7] ** 2 + second[c % 7] ** 2 for c in got]
        assert far == sorted(far)


def test_bounds_never_exceed_the_distance():
    """A point that moves into another cell has moved by at least the bound."""
    rng = np.random.default_rng(6)
    books = [e.codebook(rng.normal(size=(300, 4)), 6) for _ in range(2)]
    index = MultiIndex(*books, 1.0)
    x, y = rng.normal(size=(200, 8)), rng.normal(size=(200, 8))
    _, bounds = index.bounds(x)
    homes, _ = index.bounds(y)
    for half, (bound, home) in enumerate(zip(bounds, homes)):
        moved = np.linalg.norm(x[:, half * 4 : half * 4 + 4] - y[:, half * 4 : half * 4 + 4], axis=1)
        assert (bound[np.arange(200), home] <= moved + 1e-9).all()


def test_empty(spark):
    assert near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0
    only_bad = spark.createDataFrame([(1, None, 1), (2, [0.0], 1)], "vec_id long, embedding array<float>, label int")
    assert sorted(tuple(r) for r in near_vectors(only_bad).collect()) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_recall_of_the_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    want = brute(rows)
    got = sorted((tuple(r) for r in op7_embeddings(spark, sf_dir).collect()), key=str)
    found, all_ = sum(r[1] for r in got), sum(r[1] for r in want)
    assert found <= all_ and found >= 0.9 * all_
    assert got == want


@pytest.mark.parametrize("dim", [1, 2, 3])
def test_small_dimensions(spark, dim):
    rng = np.random.default_rng(dim)
    check(spark, [(i, [float(np.float32(c)) for c in rng.normal(size=dim)], i % 2) for i in range(60)])


def test_links_of_small_groups_beside_a_large_one(spark):
    """A tight group holds nearly all links; those of pairs across cell borders count all the same."""
    rng = np.random.default_rng(8)
    base = rng.normal(size=16)
    points = [base + rng.normal(size=16) * 1e-4 for _ in range(900)]
    for _ in range(900):
        one, way = (v / np.linalg.norm(v) for v in rng.normal(size=(2, 16)))
        way -= (way @ one) * one
        points += [one, one + 0.19 * way / np.linalg.norm(way)]
    rows = [(i, [float(np.float32(c)) for c in v], 0) for i, v in enumerate(points)]
    unit = np.array([v for _, v, _ in rows])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    want = ((unit @ unit.T >= 0.98).sum(axis=1) - 1).tolist()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r["vec_id"]: r["n_links"] for r in near_vectors(df).collect()}
    assert [got[i] for i in range(len(rows))] == want


def on_disk(spark):
    """Bytes in shuffle files and in the shared folder."""
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    files = found.split("\n") if found else []
    root = f"{shared_root(spark)}/dockwise/{spark.sparkContext.applicationId}".removeprefix("file://")
    files += [f"{folder}/{name}" for folder, _, names in os.walk(root) for name in names]
    return sum(os.path.getsize(f) for f in files if os.path.exists(f))


def test_vectors_are_written_few_times(spark):
    """Visits of many cells copy no vectors: disk stays within a few times the input."""
    x = np.random.default_rng(9).normal(size=(24_000, 64)).astype("<f4")
    frame = pd.DataFrame({"vec_id": np.arange(len(x)), "embedding": x.tolist(), "label": np.arange(len(x)) % 4})
    rows = spark.createDataFrame(frame, "vec_id long, embedding array<float>, label int")
    before, most, ended = on_disk(spark), [0], threading.Event()

    def watch():
        while not ended.wait(0.05):
            most.append(on_disk(spark) - before)

    watcher = threading.Thread(target=watch)
    watcher.start()
    try:
        assert near_vectors(rows).filter("n_links = 0 AND kept").count() == len(x)
    finally:
        ended.set()
        watcher.join()
    assert 0 < max(most) < 8 * x.nbytes  # the sample, all of so small a table, is shuffled besides


def test_blocks_and_pieces(spark, monkeypatch):
    """Vectors lie in blocks of a few, which meet in smaller pieces; equal ones come from several partitions."""
    rows = made(np.random.default_rng(10), 50, 16)
    rows += [(1000 + i, v, label) for i, v, label in rows[:40]]
    lay, link = e.lay_vectors, e.link_vectors
    monkeypatch.setattr(e, "lay_vectors", lambda p, index, root: lay(p, index, root, block=13))
    monkeypatch.setattr(e, "link_vectors", lambda b, index, t: link(b, index, t, block=5))
    check(spark, rows)


def test_dense_group_and_low_threshold(spark):
    """Nearly all vectors of a label link; others do at a cosine that is met by chance."""
    rng = np.random.default_rng(11)
    base = rng.normal(size=16)
    rows = [(i, [float(np.float32(c)) for c in base + rng.normal(size=16) * 0.14], 0) for i in range(330)]
    rows += [(400 + i, [float(np.float32(c)) for c in rng.normal(size=16)], 1) for i in range(150)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    for threshold in (0.98, 0.5):
        got = near_vectors(df, threshold=threshold)
        assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, threshold)


def test_negative_zeros_and_equal_vectors_of_several_batches(spark):
    """Zeros of either sign are equal; equal vectors of several partitions are one."""
    rows = [(i, [0.0 if i % 2 else -0.0, 1.0, float(i % 3)], 0) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(7)
    got = near_vectors(df, threshold=1.0).groupBy("component_id").count().collect()
    assert sorted(tuple(r) for r in got) == [(0, 14), (1, 13), (2, 13)]
