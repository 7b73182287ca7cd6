"""The Merkle manifest against a plain build of the whole tree, and its check of rows."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from bindings.check import compare
from dockwise.llm import merkle
from dockwise.llm.merkle import Appender, fold, manifest, op11_merkle, ranked, tampered, verified

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    def enc(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    return sha("".join(enc(v) for v in (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)))


def tree(nodes, arity=3):
    """(root, siblings of every node, places and siblings by level)"""
    steps = [[] for _ in nodes]
    under = [[k] for k in range(len(nodes))]
    while len(nodes) > 1:
        above, spans = [], []
        for at in range(0, len(nodes), arity):
            run = nodes[at : at + arity]
            for place in range(len(run)):
                for k in under[at + place]:
                    steps[k].append((place, run[:place] + run[place + 1 :]))
            above.append(sha("".join(run)))
            spans.append([k for u in under[at : at + arity] for k in u])
        nodes, under = above, spans
    return nodes[0], steps


def brute(rows, arity=3):
    """doc_id -> (leaf, subroot, root, proof, folded root, verified) for rows with distinct ids"""
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    found, subroots = {}, []
    for name in names:
        own = sorted(groups[name], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0))
        root, steps = tree([leaf(r, r["text"]) for r in own], arity)
        subroots.append(root)
        for r, s in zip(own, steps):
            found[r["doc_id"]] = (r, root, s)
    root, tops = tree(subroots, arity)
    out = {}
    for i, (r, sub, steps) in found.items():
        path = steps + tops[names.index(r["source"])]
        text = r["text"]
        if i is not None and zlib.crc32(str(i).encode()) % 2 == 0 and text is not None:
            text = text.replace("\n", "")
        node = leaf(r, text)
        for place, siblings in path:
            node = sha("".join(siblings[:place] + [node] + siblings[place:]))
        proof = sha("".join(s for _, siblings in path for s in siblings))
        out[i] = (leaf(r, r["text"]), sub, root, proof, node, node == root)
    return out


def answers(df):
    siblings = F.regexp_replace("witness", "(^|/)[0-9]+:", "")
    found = verified(df).withColumn("proof", F.sha2(siblings.cast("binary"), 256)).collect()
    return {r["doc_id"]: (r["leaf"], r["subroot"], r["root"], r["proof"], r["folded_root"], r["verified"]) for r in found}


@pytest.mark.parametrize("arity", [2, 3])
def test_appender_witnesses(arity):
    for n in range(1, 40):
        leaves = [sha(str(k)) for k in range(n)]
        grown = Appender(arity)
        for k, one in enumerate(leaves):
            grown.append(one)
            # what a partial witness holds already is what the whole one begins with
        partial = [list(w) for w in grown.witness]
        root = grown.close(None)
        assert root == tree(leaves, arity)[0]
        for one, before, after in zip(leaves, partial, grown.witness):
            assert after[: len(before)] == before
            assert fold(one, "/".join(after)) == root


def test_ranks_over_parts(spark):
    rng = random.Random(5)
    rows = [("hot" if rng.random() < 0.6 else f"t{rng.randrange(9)}", rng.randrange(300)) for _ in range(2_000)]
    got = ranked(spark.createDataFrame(rows, "tree string, id long").repartition(7), ["id"]).collect()
    for name in {t for t, _ in rows}:
        own = sorted((r["rank"], r["id"]) for r in got if r["tree"] == name)
        assert [k for k, _ in own] == list(range(len(own)))
        assert [i for _, i in own] == sorted(i for t, i in rows if t == name)


@pytest.mark.parametrize("height", [1, 2, 6])
def test_trees_of_every_size_in_blocks(spark, height):
    rows = []
    for size in [1, 2, 3, 4, 8, 9, 10, 27, 28, 61]:
        for _ in range(size):
            i = len(rows) * 7 % 1009
            rows.append((i, f"line {i}\nnext" if i % 3 else f"line {i}", "en", f"s{size}", i))
    docs = spark.createDataFrame(rows, SCHEMA)
    assert answers(manifest(docs, tampered(), height=height)) == brute(docs.collect())


def test_odd_rows(spark):
    long = "a line\n" * 60_000
    rows = [
        (1, None, None, None, None),
        (2, "", "en", None, 0),
        (3, long, "en", "", 1),
        (4, "x\ny", None, "", 1),
        (None, "x\ny", "de", "é", 3),
        (-5, "x\ny", "de", "é", 3),
        (6, "x\ny", "de", "z", 3),
        (8, "one\ntwo", "de", "\U0001f600", 3),
        (9, "one\ntwo", "de", "￮", 3),
    ]
    docs = spark.createDataFrame([(*r, "mine", "w") for r in rows], SCHEMA + ", leaf string, witness string")
    assert answers(manifest(docs, tampered())) == brute(docs.collect())
    assert manifest(docs.limit(0)).count() == 0
    one = answers(manifest(docs.filter("doc_id = 8")))[8]
    assert one[0] == one[1] == one[2] == one[4] and one[3] == sha("")


def test_repeated_rows_are_leaves_of_their_own(spark):
    docs = spark.createDataFrame([(1, "a", "en", "s", 1)] * 5 + [(1, "b", "en", "s", 1)], SCHEMA)
    found = verified(manifest(docs)).collect()
    assert len(found) == 6 and all(r["verified"] for r in found)
    assert {r["root"] for r in found} == {tree(sorted([leaf(r, r["text"]) for r in docs.collect()]))[0]}


def test_query(spark, sf_dir, database):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    want = brute(docs)
    df = op11_merkle(spark, sf_dir)
    names = ["leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert {r["doc_id"]: tuple(r[n] for n in names) for r in df.collect()} == want
    assert 0 < sum(not w[-1] for w in want.values()) < len(want)
    assert compare(df, database, merkle.SQL["op11_merkle"])[0] == "same"
