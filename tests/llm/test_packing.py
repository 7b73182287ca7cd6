"""Packing against brute force."""

import itertools
import random

import numpy as np
from pyspark.sql import functions as F

from dockwise.llm.packing import FINE, _bin, best_boundaries, length_bin, op9_packing, pack


def brute_padding(lengths, buckets):
    tops = sorted(set(lengths))
    best = None
    for k in range(1, min(buckets, len(tops)) + 1):
        for cut in itertools.combinations(tops[:-1], k - 1):
            bounds = [*cut, tops[-1]]
            cost = sum(min(b for b in bounds if b >= n) - n for n in lengths)
            best = cost if best is None else min(best, cost)
    return best


def test_boundaries_are_optimal():
    rng = random.Random(5)
    for _ in range(30):
        lengths = [rng.randint(1, 40) for _ in range(rng.randint(1, 25))]
        tops = sorted(set(lengths))
        rows = np.array([lengths.count(t) for t in tops])
        bounds = best_boundaries(np.array(tops, float), rows, rows * np.array(tops), 3)
        cost = sum(min(b for b in bounds if b >= n) - n for n in lengths)
        assert len(bounds) <= 3 and cost == brute_padding(lengths, 3)


def test_bins_agree_and_are_ordered(spark):
    values = [*range(1, 3000), 2**20 - 1, 2**20, 2**31, 2**40 + 12345, 2**62]
    got = spark.createDataFrame([(v,) for v in values], "n long").select("n", length_bin(F.col("n")).alias("b")).collect()
    bins = [r["b"] for r in sorted(got)]
    assert bins == [_bin(v) for v in values]
    assert bins == sorted(bins) and bins[FINE - 1] == FINE and bins[-1] < 16_000


def expected(docs, buckets, budget):
    rows = sorted(((len((t or "").encode().split()) + 1), -1 if i is None else i) for i, t in docs)
    tops = sorted({n for n, _ in rows})
    count = np.array([sum(n == t for n, _ in rows) for t in tops])
    bounds = best_boundaries(np.array(tops, float), count, count * np.array(tops), buckets)
    out, seen = [], {}
    for n, i in rows:
        k = next(j for j, b in enumerate(bounds) if b >= n)
        place = seen.get(k, 0)
        seen[k] = place + 1
        room = max(1, budget // bounds[k])
        out.append((i, n, k, bounds[k], place // room, place % room))
    return sorted(out)


def test_batches(spark):
    rng = random.Random(1)
    docs = [(i, " ".join("w" for _ in range(rng.choice([3, 3, 3, 9, 20, 400, 2000])))) for i in range(300)]
    docs += [(300, None), (301, " \t\n "), (-5, "a"), (None, "one two"), (10**15, "x\x0by z")]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, bucket string, place int")
    got = sorted(tuple(-1 if v is None else v for v in r) for r in pack(df, buckets=4, budget=5000).collect())
    assert got == expected(docs, 4, 5000)


def test_empty(spark):
    assert pack(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query_keeps_to_the_budget(spark, sf_dir):
    rows = op9_packing(spark, sf_dir)
    assert rows.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    batches = rows.groupBy("bucket", "batch", "padded_length").agg(F.count("*").alias("n"), F.max("slot").alias("last")).collect()
    assert all(b["n"] * b["padded_length"] <= 65_536 or b["n"] == 1 for b in batches)
    assert all(b["last"] == b["n"] - 1 for b in batches)
