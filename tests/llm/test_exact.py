"""Exact dedup against brute force, and the directory of its index."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from dockwise.llm.exact import directory, drop_copies, exact_dedup, op4_exact_dedup


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((i, t or ""))
    out = []
    for key, found in groups.items():
        keep = min(found, key=lambda r: (-len(r[1]), r[0] is None, r[0]))[0]
        sha = hashlib.sha256(key.encode()).hexdigest()
        out += [(i, keep, len(found), i == keep, sha) for i, _ in found]
    return sorted(out, key=str)


def made(rng, n):
    words = ["a", "b", "é", " ", "x\x0by", "\U0001f600"]
    rows = [(i, rng.choice(["", " ", "\n"]).join(rng.choice(words) for _ in range(rng.randint(0, 4)))) for i in range(n)]
    return rows + [(n, None), (n + 1, " \t\r\n\x0b\x0c"), (-7, "a b"), (3, rows[3][1]), (None, "a b  "), (None, "alone")]


def test_odd_rows(spark):
    rows = made(random.Random(4), 300)
    rows.append((10**6, "z " * 50_000))
    df = spark.createDataFrame([(i, t, 1, 2.0) for i, t in rows], "doc_id long, text string, h int, bucket double")
    got = sorted((tuple(r)[:5] for r in exact_dedup(df, capacity=4, max_depth=6).collect()), key=str)
    assert got == brute(rows)
    assert exact_dedup(df.limit(0)).count() == 0


def test_capacity_changes_no_result(spark):
    rows = made(random.Random(6), 120)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for capacity, depth in ((1, 3), (5, 10), (10**6, 16)):
        got = sorted((tuple(r)[:5] for r in exact_dedup(df, capacity=capacity, max_depth=depth).collect()), key=str)
        assert got == brute(rows)


def test_directory_splits_only_overfull_buckets(spark):
    """Half the hashes lie under one eighth of the key space: only that part is split deep."""
    dense = spark.range(800).select((F.shiftrightunsigned(F.xxhash64("id"), 3)).alias("h"))
    spread = spark.range(800).select(F.xxhash64("id", F.lit(1)).alias("h"))
    entries = dense.unionByName(spread)
    slots = directory(entries, capacity=120, max_depth=8)
    found = entries.distinct().withColumn("slot", F.shiftrightunsigned("h", 56)).join(slots, "slot")
    assert found.count() == entries.distinct().count()
    load = found.groupBy("bucket", "local_depth").count().collect()
    assert all(r["count"] <= 120 or r["local_depth"] == 8 for r in load)
    assert len({r["local_depth"] for r in load}) > 1
    for r in slots.collect():  # a bucket is the leading bits of its slots
        assert r["slot"] >> (8 - r["local_depth"]) == r["bucket"]


def test_drop_copies(spark):
    rows = [(1, "a b"), (2, "ab "), (2, "ab "), (3, "a  b "), (4, "c"), (4, "c"), (None, "d"), (None, "d"), (5, None), (6, "")]
    df = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, _id int")
    got = drop_copies(df)
    assert got.columns == df.columns
    assert sorted((r["doc_id"] or 0, r["text"]) for r in got.collect()) == [(0, "d"), (3, "a  b "), (4, "c"), (5, None)]


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = op4_exact_dedup(spark, sf_dir)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
