"""BPE against the tokenizers library."""

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dockwise.llm.bpe import REMEMBER, Vocabulary, decode, default_path, encode, op1_bpe, round_trip

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(default_path())


@pytest.fixture(scope="module")
def known():
    return Vocabulary(default_path())


ALPHABET = "ab \n\t'sS1٣é  \x1c\x1f\x85​漢\U0001f600<|endoftext|>.,edtheing"


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from(ALPHABET), max_size=60) | st.text(max_size=30))
def test_ids_and_text(library, known, text):
    text = text.encode("utf-8", "ignore").decode()
    want = library.encode(text, add_special_tokens=False).ids
    assert known.encode(text) == want
    assert known.decode(want) == library.decode(want, skip_special_tokens=False) == text


def test_long_pieces_and_special_strings(library, known):
    rng = random.Random(3)
    for text in (
        "".join(rng.choice("abtheing") for _ in range(30_000)),
        "<|endoftext|><|endoftext|>x <|endoftext|",
        "a" * 5001,
        " " * 700 + "x" + "\n" * 300,
        "",
    ):
        assert known.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_memory_is_bounded(known):
    known.known.clear()
    for k in range(3):
        known.encode(" ".join(f"q{k}x{i}" for i in range(REMEMBER // 3)) + " " + "z" * 5000 + "1" * 5000)
        assert max(map(len, known.known)) <= 64
        assert len(known.known) <= REMEMBER


def test_operators(spark, library):
    texts = ["The river", None, "", "The river", "été <|endoftext|> end", "x" * 20_000]
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(None, "no id", "clash")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    coded = encode(docs, default_path())
    got = {r["doc_id"]: list(r["ids"]) for r in coded.collect()}
    assert got == {i: library.encode(t or "", add_special_tokens=False).ids for i, t, _ in rows}
    back = {r["doc_id"]: r["text"] for r in decode(coded, default_path()).collect()}
    assert back == {i: t or "" for i, t, _ in rows}
    assert encode(docs.limit(0), default_path()).count() == 0


def test_query(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()

    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    want = set()
    for doc in docs:
        ids = library.encode(doc["text"] or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want.add((doc["doc_id"], len(ids), sha(",".join(map(str, ids))), sha(decoded)))
    assert {tuple(r) for r in op1_bpe(spark, sf_dir).collect()} == want
    assert round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet"), default_path()).columns == ["doc_id", "ids", "text"]


def test_narrow_pattern():
    """Every character up to U+02AF, beside letters, numbers, spaces and marks, splits as the pattern says."""
    import regex

    from dockwise.llm.bpe import PATTERN, pieces_of

    want = regex.compile(PATTERN).findall
    for c in map(chr, range(0x2B2)):
        for text in (c, "a" + c, c + "a", " " + c, c + " b", "1" + c, c + "1", c + c, f"  {c} .{c}", f"'{c}'s"):
            assert pieces_of(text) == want(text)


def test_many_texts_at_once(known):
    """Texts coded together equal texts coded alone, ids that cut a character and empty texts included."""
    import numpy as np
    import pyarrow as pa

    texts = ["", "The river", "été 漢\U0001f600", "", "<|endoftext|>x <|endoftext|>", "z" * 3000, ""]
    for some in (texts, [""], ["", ""], []):
        flat, ends = known.encode_all(some)
        assert [flat[a:b].tolist() for a, b in zip(ends, ends[1:])] == [known.encode(t) for t in some]
        assert known.decode_all(flat, ends).to_pylist() == some
    flat, ends = known.encode_all(["a漢", "é漢"])
    cut = np.array([0, 1, 2, len(flat) - 1])
    got = known.decode_all(flat[:-1], cut)
    assert got.type == pa.string() and got.to_pylist() == [known.decode(flat[a:b]) for a, b in zip(cut, cut[1:])]
    assert any("�" in t for t in got.to_pylist())


def test_texts_of_known_pieces_merge_nothing_again(known, monkeypatch):
    """Pieces are remembered without what stands beside them: new neighbours cost no merge."""
    known.encode_all(["red, green. blue; white!", "Red"])
    asked = []
    monkeypatch.setattr(known, "merge_many", lambda words: asked.extend(words) or [])
    known.encode_all(["red; green, blue. white;", "red green! white."])
    assert not asked
