"""Language-model scores: base scores exactly, the network by its gradient, the rest by brute force."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from dockwise.llm import gru
from dockwise.llm import lm_scoring as lm


def test_gradient():
    """Backpropagation agrees with differences of the loss."""
    rng = np.random.default_rng(0)
    shape = gru.Shape(50, 3, 4)
    model = gru.Model(shape, shape.start(np.zeros(7), np.zeros((3, gru.PER_CLASS))))
    model.flat = model.flat.astype(np.float64) * 3
    model.p = shape.views(model.flat)
    inputs, valid = rng.integers(0, 50, (gru.WINDOW, 5)), rng.random((gru.WINDOW, 5)) > 0.2
    keep = (rng.random((gru.WINDOW, 5)) > 0.2).astype(float)
    classes, words = rng.integers(0, 7, valid.shape), rng.integers(0, gru.PER_CLASS, valid.shape)
    h = rng.normal(size=(gru.STATE, 5))
    grad, _ = model.gradient(inputs, keep, valid, classes, words, h)

    def loss():
        out, _, _ = model.states(inputs, keep, h)
        use = valid.ravel()
        flat = out.reshape(gru.STATE, -1)[:, use].astype(float)
        return -model.log_probs(flat, classes.ravel()[use], words.ravel()[use]).mean()

    for k in rng.integers(0, shape.size, 150):
        old = model.flat[k]
        model.flat[k] = old + 1e-2
        high = loss()
        model.flat[k] = old - 1e-2
        low = loss()
        model.flat[k] = old
        assert abs((high - low) / 2e-2 - grad[k]) < 1e-4


def small_lexicon():
    hot = [(f"w{i}", 1000 - i) for i in range(700)] + [("", 50)]
    return lm.lexicon(hot, sum(c for _, c in hot) + 400)


def test_probabilities_sum_to_one():
    """Over classes, over the words of a class, and over the words of a band."""
    lex = small_lexicon()
    model = gru.Model(lex.shape, lex.shape.start(lex.class_log, lex.word_log))
    hidden = np.random.default_rng(1).normal(size=(gru.STATE, 1)).astype(np.float32)
    other = len(lex.place)
    rows = np.arange(other + 1)
    logs = model.log_probs(np.repeat(hidden, other + 1, axis=1), lex.classes, lex.words) + lex.fixed * math.log(10)
    assert abs(np.exp(logs).sum() - 1) < 1e-3
    assert len(rows) == len(lex.inputs) and lex.inputs.max() == lex.shape.inputs - 1


def test_state_runs_through_windows_and_not_between_documents():
    """Scores in lanes equal the scores of each document alone, of any length."""
    lex = small_lexicon()
    model = gru.Model(lex.shape, lex.shape.start(lex.class_log, lex.word_log) * 3)
    rng = np.random.default_rng(2)
    places = [rng.integers(0, len(lex.place) + 1, n).astype(np.int32) for n in (1, 500, 17, 16, 1, 33, 90, 3)]
    together = lm.Tokens(lex, places)
    logs = model.score(together.lanes, together.inputs, together.keep, together.classes, together.words)
    sums = np.add.reduceat(logs, together.starts)
    for at, doc in enumerate(together.lanes.order):
        alone = lm.Tokens(lex, [places[doc]])
        found = model.score(alone.lanes, alone.inputs, alone.keep, alone.classes, alone.words)
        assert sums[at] == pytest.approx(found.sum(), rel=1e-4)
        # step by step, without windows
        h, total = np.zeros((gru.STATE, 1), dtype=np.float32), 0.0
        for t in range(len(places[doc])):
            out, h, _ = model.states(alone.inputs[t : t + 1, None], np.ones((1, 1), dtype=np.float32), h)
            total += model.log_probs(out[:, 0], alone.classes[t : t + 1], alone.words[t : t + 1])[0]
        assert found.sum() == pytest.approx(total, rel=1e-4)


def brute(rows, learns):
    counts = Counter()
    for i, t in rows:
        if learns(i):
            counts.update(lm.words_of(t or ""))
    total, distinct = sum(counts.values()), len(counts)
    out = {}
    for i, t in rows:
        words = lm.words_of(t or "")
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in words)
        out.setdefault(i, []).append((len(words), sum(counts[w] > 0 for w in words), total, base))
    return out


def agree(got, want):
    for r in got:
        options = want[r["doc_id"]]
        assert any(
            (r["n_tokens"], r["n_known"], r["train_tokens"]) == o[:3] and r["base_score"] == pytest.approx(o[3], rel=1e-9)
            for o in options
        )
        assert math.isfinite(r["score"]) and r["score"] < 0


ROWS = [(i, f"the river W{i % 7} rose\tand The\x0bfields é{i} stood " * (i % 5)) for i in range(80)]
ROWS += [(80, None), (81, " \n"), (None, "the river"), (3, "the river"), (3, "the river"), (82, "long words " * 40_000)]


@pytest.mark.parametrize("hot", [0, 5, 10**6])
def test_base_scores(spark, hot):
    """The number of words that tasks know by heart changes no base score."""
    df = spark.createDataFrame([(i, t, "x") for i, t in ROWS], "doc_id long, text string, word string")
    got = lm.lm_scores(df, F.col("doc_id") % 3 != 0, hot=hot).collect()
    assert len(got) == len(ROWS)
    agree(got, brute(ROWS, lambda i: i is not None and i % 3 != 0))


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in lm.lm_scores(df, F.lit(False)).collect()}
    assert got[1]["train_tokens"] == got[1]["n_known"] == 0 and got[1]["base_score"] == 0
    assert lm.lm_scores(df.limit(0), F.lit(True)).count() == 0


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    out = zlib.crc32
    got = lm.op10_lm(spark, sf_dir).collect()
    assert len(got) == len(rows)
    agree(got, brute(rows, lambda i: out(str(i).encode()) % 7 != 2))
    assert all(r["held_out"] == (out(str(r["doc_id"]).encode()) % 7 == 2) for r in got)
    held = [r for r in got if r["held_out"]]
    # the network is worth more than the unigram on documents it has not seen
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_scores_do_not_depend_on_the_layout(spark, sf_dir, monkeypatch):
    """One, eight and 64 partitions give the same scores, and better ones than the words alone on rows held out."""
    monkeypatch.setattr(lm, "SHARD_TOKENS", 4_000)  # several shards in a round
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = []
    for parts in (1, 8, 64):
        rows = lm.lm_scores(docs.repartition(parts), ~lm.held_out()).collect()
        found.append({r["doc_id"]: (r["base_score"], r["score"]) for r in rows})
    for other in found[1:]:
        assert other.keys() == found[0].keys()
        for i, (base, score) in other.items():
            assert base == pytest.approx(found[0][i][0], rel=1e-9)
            assert score == pytest.approx(found[0][i][1], rel=1e-6)
    held = [found[0][i] for i in found[0] if zlib.crc32(str(i).encode()) % 7 == 2]
    assert sum(s for _, s in held) > sum(b for b, _ in held)


def test_texts_split_together():
    """Every white space and no other splits, A-Z alone are lowered, and each text has one end."""
    import pyarrow as pa

    texts = [" A\x0bb\x1cC d\x85e\tÀB  \r\n", "", " ", "one", " x Y z\x00", "KK İ ONE one", "\n\n a"]
    for some in (texts, [], [""], ["a"]):
        words, flat, n = lm.split(pa.array(some, pa.string()))
        found = [words[int(k)].as_py().encode() for k in flat]
        assert found == [w for t in some for w in lm.words_of(t)]
        assert n.tolist() == [len(lm.words_of(t)) for t in some]


def test_tokens_are_handled_in_arrow(spark):
    """Counting takes whole batches of texts, not word by word in Python."""
    df = spark.createDataFrame([(1, "a b A"), (2, None)], "doc_id long, text string")
    counts = lm.count_tokens(df.select(lm.whole_text("text").alias("text")))
    assert "MapInArrow" in counts._jdf.queryExecution().executedPlan().toString()
    assert {r["word"]: r["c"] for r in counts.collect()} == {"a": 2, "b": 1, "": 2}


def test_every_hot_word_has_a_place():
    """Ranked words beyond the softmax differ in the model both as inputs and as guesses, and all sums to one."""
    n = 3000
    lex = lm.lexicon([(f"w{i}", 4000 - i) for i in range(n)], 5 * 10**6)
    assert len({(c, w) for c, w in zip(lex.classes, lex.words)}) == len(set(lex.inputs)) == n + 1
    shape, rng = lex.shape, np.random.default_rng(4)
    model = gru.Model(shape, shape.start(lex.class_log, lex.word_log, lex.count))
    hidden = np.repeat(rng.normal(size=(gru.STATE, 1)).astype(np.float32), n + 1, axis=1)
    began = model.log_probs(hidden, lex.classes, lex.words)
    assert np.exp(began.astype(float)).sum() == pytest.approx(1, abs=1e-3)
    # words of a tree begin with what their band shares
    assert began[1500] - began[1600] == pytest.approx(math.log(2500 / 2400), abs=1e-3)
    model.flat[:] += rng.normal(0, 0.5, shape.size)
    logs = model.log_probs(hidden, lex.classes, lex.words)
    assert np.exp(logs.astype(float)).sum() == pytest.approx(1, abs=1e-3)
    # "2000 1100" and "2002 2900" alternate: the model learns which word follows which
    docs = [np.array([2000, 1100] * 40, dtype=np.int32), np.array([2002, 2900] * 40, dtype=np.int32)] * 16
    model = gru.Model(shape, shape.start(lex.class_log, lex.word_log, lex.count))
    tokens = lm.Tokens(lex, docs, 8)

    def score(doc):
        t = lm.Tokens(lex, [np.array(doc, dtype=np.int32)])
        return model.score(t.lanes, t.inputs, t.keep, t.classes, t.words).sum()

    for _ in range(30):
        model.learn(tokens.lanes, tokens.inputs, tokens.keep, tokens.classes, tokens.words)
    assert score([2000, 1100] * 10) > score([2000, 2900] * 10) + 5
    assert score([2002, 2900] * 10) > score([2002, 1100] * 10) + 5


def test_gradient_of_trees():
    rng = np.random.default_rng(0)
    shape = gru.Shape(800, 16, 2, 800)
    model = gru.Model(shape, shape.start(np.zeros(18), np.zeros((16, gru.PER_CLASS))))
    model.flat = rng.normal(0, 0.3, shape.size)
    model.p = shape.views(model.flat)
    inputs, valid = rng.integers(0, 800, (gru.WINDOW, 5)), rng.random((gru.WINDOW, 5)) > 0.2
    keep, ranks = (rng.random((gru.WINDOW, 5)) > 0.2).astype(float), rng.integers(500, 800, valid.shape)
    classes, words = np.where(ranks < 512, 15, 16), np.where(ranks < 512, ranks % 32, ranks)
    h = rng.normal(size=(gru.STATE, 5))
    grad, _ = model.gradient(inputs, keep, valid, classes, words, h)

    def loss():
        out, _, _ = model.states(inputs, keep, h)
        use = valid.ravel()
        return -model.log_probs(out.reshape(gru.STATE, -1)[:, use], classes.ravel()[use], words.ravel()[use]).mean()

    for k in [*rng.choice(np.flatnonzero(grad), 200), *rng.integers(0, shape.size, 50)]:
        old = model.flat[k]
        model.flat[k] = old + 1e-4
        high = loss()
        model.flat[k] = old - 1e-4
        low = loss()
        model.flat[k] = old
        assert abs((high - low) / 2e-4 - grad[k]) < 1e-6


def test_moves_are_averaged_over_the_shards_that_touched_them():
    import pandas as pd

    shape = gru.Shape(1300, 16, 3, 1300)
    old = np.zeros(shape.size, dtype=np.float32)
    one, two = old.copy(), old.copy()
    shape.views(one)["E"][[3, 900]] = 1
    shape.views(two)["E"][[3, 1299]] = 4
    shape.views(two)["T"][1030, 16] = 0.5
    one[5] = 3
    rows = [r for new, n in ((one, 1), (two, 2)) for part in lm.moved(shape, old, new, n) for r in part]
    frame = pd.DataFrame(sorted(rows), columns=["part", "at", "w", "n"])
    got = old.copy()
    for batch in lm.average(iter([frame[:2], frame[2:]])):
        for part, at, w in batch.itertuples(index=False):
            at = np.frombuffer(at, dtype=np.uint8).astype(int)
            lm.matrices(shape, got)[part >> 24][(part & 0xFFFFFF) * lm.PART_ROWS + at] += np.frombuffer(w, dtype=np.float32).reshape(len(at), -1)
    want = old.copy()
    shape.views(want)["E"][[3, 900, 1299]] = [[3], [1], [4]]
    shape.views(want)["T"][1030, 16] = 0.5
    want[5] = 3
    assert np.allclose(got, want)
