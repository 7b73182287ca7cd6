"""Quality scores: statistics, fit, calibration and held-out accuracy."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from dockwise.llm import quality as q


def test_statistics():
    assert q.statistics("") == [0.0] * len(q.STATISTICS)
    for text in (" \n\t", "a", "é", "x" * 200_000, "one two\nthree\n" * 30_000, "\0\x7f"):
        found = q.statistics(text)
        assert len(found) == len(q.STATISTICS) and np.isfinite(found).all()
    found = dict(zip(q.STATISTICS, q.statistics("Aa aa AA 12.\nAa aa")))
    assert found["digits"] == 2 / 18 and found["upper"] == 4 / 18
    assert found["distinct"] == 4 / 6 and found["capital_words"] == 1 / 6
    assert found["repeated_pairs"] == 1 - 4 / 5


def test_pool_adjacent_by_brute_force():
    """No rising sequence over a grid of values is nearer."""
    rng = np.random.default_rng(1)
    for _ in range(20):
        value, weight = rng.integers(0, 5, 5) / 4.0, rng.integers(1, 4, 5).astype(float)
        got = q.pool_adjacent(value, weight)
        assert (np.diff(got) >= -1e-12).all()
        grid = sorted({v.mean() for i in range(5) for j in range(i + 1, 6) for v in [np.repeat(value[i:j], weight[i:j].astype(int))]})
        best = {0: {g: (g - value[0]) ** 2 * weight[0] for g in grid}}
        for k in range(1, 5):
            best[k] = {g: (g - value[k]) ** 2 * weight[k] + min(c for h, c in best[k - 1].items() if h <= g) for g in grid}
        assert abs(((got - value) ** 2 * weight).sum() - min(best[4].values())) < 1e-9


def test_features_approximate_the_kernel():
    rng = np.random.default_rng(5)
    dims, many = len(q.STATISTICS), 40_000
    model = q.Quality(
        np.zeros(dims), np.ones(dims), rng.normal(0, dims**-0.5, (dims, many)), rng.uniform(0, 2 * np.pi, many)
    )
    x = rng.normal(size=(6, dims))
    z = model.features(x)[:, :-1]
    exact = np.exp(-((x[:, None] - x[None]) ** 2).sum(axis=2) / (2 * dims))
    np.testing.assert_allclose(z @ z.T, exact, atol=0.03)


def stats_frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, stats array<double>, quality int")


def test_ridge_equals_the_closed_form(spark):
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=len(q.STATISTICS)).tolist(), int(rng.random() < 0.5)) for i in range(300)]
    model = q.fit(stats_frame(spark, rows))
    last = {
        r["doc_id"]
        for r in stats_frame(spark, rows).filter(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(4)) == 3).collect()
    }
    x = np.array([s for _, s, _ in rows])
    np.testing.assert_allclose(model.mean, x.mean(axis=0), atol=1e-9)
    keep = np.array([i not in last for i, _, _ in rows])
    z, y = model.features(x[keep]), np.array([float(v) for _, _, v in rows])[keep]
    ridge = np.eye(z.shape[1]) * q.RIDGE * keep.sum()
    ridge[-1, -1] = 1e-9
    np.testing.assert_allclose(model.weight, np.linalg.solve(z.T @ z + ridge, z.T @ y), atol=1e-5)
    assert (np.diff(model.good) >= 0).all() and ((0 <= model.score(x)) & (model.score(x) <= 1)).all()


def test_few_rows(spark):
    one = [0.5] * len(q.STATISTICS)
    assert q.fit(stats_frame(spark, [])).score(np.zeros((2, len(q.STATISTICS)))).tolist() == [1.0, 1.0]
    for label in (0, 1):
        model = q.fit(stats_frame(spark, [(i, one, label) for i in range(3)]))
        assert model.score(np.array([one, [9.0] * len(one)])).round(6).tolist() == [label, label]
    assert q.fit(stats_frame(spark, [(i, one, i % 2) for i in range(400)]), most=50).score(np.array([one]))[0] > 0


def test_labels(spark):
    ids = [i for i in range(60)]
    stats = spark.createDataFrame([(i, [float(i)]) for i in ids] + [(None, [1.0])], "doc_id long, stats array<double>")
    labels = [(i, 1, 0) for i in ids if i > 3] + [(1, 0, None), (2, None, 1), (3, 0, 0), (3, 1, 0), (4, 1, 0), (None, 1, 0), (5, 7, 0)]
    found = q.labelled_rows(stats, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    want = {i: 1 for i in ids if i > 3} | {1: 0}
    want = {i: v for i, v in want.items() if zlib.crc32(str(i).encode()) % 4 != 2}
    assert {r["doc_id"]: r["quality"] for r in found.collect()} == want


def test_keep_good_passes_columns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = docs.withColumn("score", F.lit("mine")).withColumn("stats", F.lit(1))
    odd = odd.unionByName(odd.limit(3).withColumn("doc_id", F.lit(None).cast("long")).withColumn("text", F.lit(None).cast("string")))
    kept = q.keep_good(odd, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    assert kept.columns == odd.columns
    assert 0 < kept.count() < odd.count() and kept.filter("score = 'mine'").count() == kept.count()


def test_query_and_held_out_accuracy(spark, sf_dir):
    rows = q.op6_quality(spark, sf_dir)
    assert rows.columns == ["doc_id", "held_out", "score", "predicted"]
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").toPandas()
    got = rows.toPandas()
    assert len(got) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert (got["held_out"] == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got["doc_id"]]).all()
    assert got["score"].between(0, 1).all() and (got["predicted"] == (got["score"] >= 0.7)).all()
    held = got.merge(labels, on="doc_id")
    held = held[held["held_out"]]
    assert (held["predicted"] == held["quality"]).mean() >= 0.9
