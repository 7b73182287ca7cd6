"""SimHash near-duplicates against brute force."""

import random
import re

import numpy as np
import xxhash

from dockwise.llm import simhash
from dockwise.llm.common import components
from dockwise.llm.simhash import fingerprint, forest, near_duplicates, op2_simhash, pigeonring_links


def brute_print(text, k=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(nodes, near):
    label = {n: n for n in nodes}

    def root(n):
        while label[n] != n:
            n = label[n]
        return n

    nodes = list(nodes)
    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if near(a, b):
                x, y = sorted((root(a), root(b)))
                label[y] = x
    return {n: root(n) for n in nodes}


def cluster(rng, n, radius):
    prints = []
    for _ in range(n):
        base = rng.getrandbits(64)
        prints.append(base)
        for _ in range(rng.randint(0, 6)):
            x = base
            for bit in rng.sample(range(64), rng.randint(0, radius + 1)):
                x ^= 1 << bit
            prints.append(x)
            base = rng.choice((base, x))
    return sorted(set(prints))


def as_signed(x):
    return x - (1 << 64) if x >> 63 else x


def check_links(spark, prints, radius, **options):
    rows = [(i, as_signed(p), 0) for i, p in enumerate(prints)]
    links = pigeonring_links(spark.createDataFrame(rows, "id long, fp long, fp2 long"), radius, **options)
    got = {r["node"]: r["component_id"] for r in components(links).collect()}
    want = brute_components(range(len(prints)), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= radius)
    assert {i: got.get(i, i) for i in want} == want


def test_links_have_the_components_of_all_pairs(spark):
    rng = random.Random(11)
    check_links(spark, cluster(rng, 60, 4), 4)
    check_links(spark, cluster(rng, 40, 8), 8)


def test_hot_keys_in_blocks_and_large_groups(spark, monkeypatch):
    monkeypatch.setattr(simhash, "PAIRS", 40)  # every group counts as large in this process
    rng = random.Random(12)
    base = rng.getrandbits(64)
    ball = {base ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(150)}
    check_links(spark, sorted(ball | set(cluster(rng, 20, 4))), 4, block=16)


def test_hot_probes_in_blocks(spark):
    """A key that few are filed under and many look in: no cell holds more than two blocks."""
    rng = random.Random(21)
    base = rng.getrandbits(64) & ~(1 << 13)
    high = ~((1 << 26) - 1)
    # segments 0 and 1 (bits 0-24) equal but for bit 13, so all look in the key of the few that have it
    many = {(base & ~high) | (rng.getrandbits(64) & high) for _ in range(200)}
    few = {p | (1 << 13) for p in sorted(many)[:6]} | {((base | 1 << 13) & ~high) | (rng.getrandbits(64) & high) for _ in range(6)}
    prints = sorted(many | few)
    check_links(spark, prints, 4, block=16)
    rows = spark.createDataFrame([(i, as_signed(p), 0) for i, p in enumerate(prints)], "id long, fp long, fp2 long")
    assert max(r["count"] for r in simhash.dealt_keys(rows, 4, 16).groupBy("key", "c1", "c2").count().collect()) <= 4 * 16


def test_drop_near_copies_on_odd_rows(spark):
    base = "the old mill by the river stood under the water for many weeks and nobody came to see it again " * 9
    rows = [(3, base), (1, base + "now"), (1, "alone here"), (2, "alone here"), (7, None), (8, ""), (None, base), (9, base), (9, "quite other words")]
    out = simhash.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in out if r["text"]) == sorted(
        [(0, base), (1, base + "now"), (1, "alone here"), (9, base), (9, "quite other words")]
    )
    assert [r["doc_id"] for r in out if not r["text"]] == [7]


def test_large_group_of_many_leaders():
    rng = random.Random(13)
    prints = cluster(rng, 30, 4)
    group = simhash._Group(4, 128)
    fp = np.array(prints, dtype=np.uint64)
    a, b = group.large(fp, fp * np.uint64(0), np.arange(len(fp)), len(fp))
    got = dict(zip(a.tolist(), b.tolist()))
    want = brute_components(range(len(fp)), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 4)
    assert {i: got.get(i, i) for i in want} == want


def test_forest():
    rng = random.Random(14)
    pairs = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)]
    a, b = forest(np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs]))
    linked = {frozenset(p) for p in pairs}
    want = brute_components(range(60), lambda i, j: frozenset((i, j)) in linked)
    got = dict(zip(a.tolist(), b.tolist()))
    assert {i: got.get(i, i) for i in want} == want


def test_fingerprint():
    for text in ("", " \n", "One", "A b C d e\x0bf", "Été de la É x y z", "w " * 70_000 + "end of it all"):
        assert fingerprint(text, 4, (42,)) == [brute_print(text)]


def test_operator_on_odd_rows(spark):
    base = "the old mill by the river stood under the water for many weeks and nobody came to see it again "
    texts = {1: base * 9, 2: base * 9 + "now", 3: None, 4: "  ", 5: "alone here", 6: base.upper() * 9}
    rows = [(i, t, "x") for i, t in texts.items()] + [(1, texts[1], "x"), (None, texts[1], "x"), (None, "other words", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = near_duplicates(docs).collect()
    assert len(got) == len(rows)
    found = {(r["doc_id"], r["component_id"]) for r in got}
    assert found == {(1, 1), (2, 1), (6, 1), (3, 3), (4, 3), (5, 5), (None, 1), (None, None)}
    assert near_duplicates(docs.limit(0)).count() == 0


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    prints = {d["doc_id"]: brute_print(d["text"]) for d in docs}
    want = brute_components(sorted(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    got = {tuple(r) for r in op2_simhash(spark, sf_dir).collect()}
    assert got == {(i, f"{prints[i]:016x}", want[i]) for i in prints}


def test_two_halves_find_all_pairs(spark):
    rng = random.Random(15)
    whole = []
    for _ in range(40):
        base = rng.getrandbits(128)
        whole.append(base)
        for _ in range(rng.randint(0, 3)):
            x = base
            for bit in rng.sample(range(128), rng.randint(8, 24)):
                x ^= 1 << bit
            whole.append(x)
    low = (1 << 64) - 1
    rows = [(i, as_signed(p & low), as_signed(p >> 64)) for i, p in enumerate(whole)]
    halves = spark.createDataFrame(rows, "id long, fp long, fp2 long")
    links = pigeonring_links(halves, 9, 19).unionByName(
        pigeonring_links(halves.selectExpr("id", "fp2 AS fp", "fp AS fp2"), 9, 19)
    )
    got = {r["node"]: r["component_id"] for r in components(links).collect()}
    want = brute_components(range(len(whole)), lambda a, b: (whole[a] ^ whole[b]).bit_count() <= 19)
    assert {i: got.get(i, i) for i in want} == want
    assert len(set(want.values())) < len(whole)
