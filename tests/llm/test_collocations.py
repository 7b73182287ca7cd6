"""Collocations against a plain count of everything, and the automata against dictionaries."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from bindings.check import compare
from dockwise.llm import collocations as module
from dockwise.llm.collocations import automaton, collocations, compose, op12_collocations, paths, union


def brute(rows, least=30, inside=80, top=2000, longest=4):
    """Sorted result rows for (lang, text) rows."""
    count, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    count[(lang, *words[i : i + k])] += 1
    candidates = {p: a for p, a in count.items() if len(p) > 2 and a >= least}
    around = Counter()
    for p, a in candidates.items():
        for k in range(2, len(p) - 1):
            for i in range(1, len(p) - k + 1):
                sub = (p[0], *p[i : i + k])
                around[sub] = max(around[sub], a)
    found = {}
    for p, a in candidates.items():
        if p in around and 100 * around[p] >= inside * a:
            continue
        cuts = []
        for k in range(1, len(p) - 1):
            l, r = count[p[: k + 1]], count[(p[0], *p[k + 1 :])]
            cuts.append((2_000_000 * a // (l + r), k, l, r))
        score, _, l, r = min(cuts)
        found.setdefault(p[0], []).append((-score, -a, " ".join(p[1:]).encode(), l, r))
    return sorted(
        (lang, rank, ph.decode(), -a, l, r, n[lang], -s)
        for lang, own in found.items()
        for rank, (s, a, ph, l, r) in enumerate(sorted(own)[:top], 1)
    )


def answers(df):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


def random_counts(rng, n):
    return Counter({tuple(rng.choice("abcd") for _ in range(rng.randint(1, 4))): rng.randint(1, 3) for _ in range(n)})


def test_automata():
    rng = random.Random(3)
    for n in (0, 1, 5, 60, 200):
        one, two = random_counts(rng, n), random_counts(rng, n)
        states = automaton(sorted(one.items()))
        assert list(paths(states)) == sorted(one.items())
        assert len(states) <= 1 + sum(len(p) for p in one)
        both = union([states, automaton(sorted(two.items()))])
        assert list(paths(both)) == sorted((one + two).items())
        assert dict(paths(union([states, states], least=4))) == {p: 2 * c for p, c in one.items() if c >= 2}
        asked = automaton((p, 1) for p in sorted(two))
        assert dict(compose(asked, states)) == {p: c for p, c in one.items() if p in two}


def test_automata_of_arrays_and_their_union():
    rng = random.Random(6)
    names = [["de", "en"], *[[bytes([97 + k]) for k in range(6)]] * 3]
    for n in (1, 7, 150):
        total, want = {}, Counter()
        for _ in range(3):
            own = Counter({(rng.randrange(2), *[rng.randrange(6) for _ in range(3)]): rng.randint(1, 3) for _ in range(n)})
            places = sorted(own)
            columns = [np.array(c) for c in zip(*places)]
            states = module.automaton_of(columns, names, np.array([own[p] for p in places]))
            named = {tuple(labels[k] for labels, k in zip(names, p)): c for p, c in own.items()}
            assert list(paths(states)) == sorted(named.items())
            assert len(states) == len(automaton(sorted(named.items())))
            module.absorb(total, states, states[-1], 4)
            want.update(named)
        assert list(module.survivors(total, 3, 4)) == sorted((p, c) for p, c in want.items() if c >= 3)


def test_equal_states_are_shared():
    states = automaton([((a, b, c), 1) for a in "abcdef" for b in "abcdef" for c in "abcdef"])
    assert len(states) == 4


@pytest.mark.parametrize("bits", [64, 1 << 20])
def test_against_brute_force(spark, monkeypatch, bits):
    monkeypatch.setattr(module, "DISTINCT", 7)
    rng = random.Random(4)
    words = ["Of", "the", "old", "mill", "é", "É", "x#y", " ", "\x1f", "a\0b", "river"]
    ends = [" ", " ", " ", " \t ", ". ", ",", "\n", ";!", "\x0b", "\r\n", "?", ":"]
    rows = []
    for _ in range(240):
        text = "".join(rng.choice(words[: rng.randint(3, 11)]) + rng.choice(ends) for _ in range(rng.randint(0, 60)))
        rows.append((rng.choice(["en", "en", "de", None, "und", ""]), text))
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    for least, inside, top in [(4, 80, 2000), (9, 50, 20)]:
        want = brute(rows, least, inside, top)
        assert want and answers(collocations(docs, least=least, inside=inside, top=top, bits=bits)) == want


def test_hot_first_word_is_cut_by_its_second(spark):
    words = spark.createDataFrame(
        [("en", "the", 9_000)] + [("en", f"w{k:03}", 10) for k in range(300)], "lang string, phrase string, f long"
    )
    cuts = module.prefix_cuts(words, 12_000, 8)
    assert cuts == sorted(cuts) and sum(len(c) == 3 and c[1] == b"the" for c in cuts) >= 4


def test_odd_rows(spark):
    rows = [(None, None, "x"), ("en", "", "x"), ("en", " \t\n.", "x"), ("de", "so it is " * 40_000, "x"), ("und", "a b", "x")]
    rows += [(None, "a b", "x")] * 40
    docs = spark.createDataFrame(rows, "lang string, text string, phrase string")
    assert answers(collocations(docs)) == brute([r[:2] for r in rows])
    assert answers(collocations(docs.limit(0))) == []
    assert answers(collocations(docs.filter("lang = 'en'"))) == []


def test_query(spark, sf_dir, database):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "text").collect()]
    df = op12_collocations(spark, sf_dir)
    want = brute(rows)
    assert want and answers(df) == want
    assert compare(df, database, module.SQL["op12_collocations"])[0] == "same"
