"""Quality rules against a plain version in Python, row by row."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from bindings.check import compare
from dockwise.llm import line_rules as module
from dockwise.llm.line_rules import clean_lines, keep_clean, op13_rules, repeated_words

WORD = r"[^\x20\x09-\x0D]+"


def pattern(text):
    return re.compile(re.sub(r"\\x\{([0-9A-F]+)\}", lambda m: f"\\u{int(m.group(1), 16):04x}", text))


NOTICES, MENU, ENDS, MARKS, SEPARATORS = (
    pattern(getattr(module, n)) for n in ("NOTICES", "MENU", "ENDS", "MARKS", "SEPARATORS")
)


def repeats(words, width=3):
    windows = [tuple(words[i : i + width]) for i in range(len(words) - width + 1)]
    count = Counter(windows)
    return len({i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(width)})


def rule(line):
    words = re.findall(WORD, line)
    separators = len(SEPARATORS.findall(line))
    if not words:
        return None
    if len(words) < 40 and NOTICES.search(line):
        return "boilerplate"
    if MENU.search(line) or separators >= 2 and 4 * separators >= len(words):
        return "navigation"
    if 5 * len(MARKS.findall(line)) > len(words) or len(words) < 10 and not ENDS.search(line):
        return "punctuation"
    return None


def judged(text):
    text = text or ""
    words, lines = re.findall(WORD, text), text.split("\n")
    rules = [rule(x) for x in lines]
    chars = [sum(map(len, re.findall(WORD, x))) for x in lines]
    wordy = [x for x in lines if re.search(WORD, x)]
    lost, whole, again = sum(c for c, r in zip(chars, rules) if r), sum(chars), repeats(words)
    failed = len(words) < 50 or 100 * again > 50 * len(words)
    return {
        "clean_text": "\n".join(x for x, r in zip(lines, rules) if not r),
        "failed": {r: rules.count(r) for r in module.RULES},
        "n_words": len(words),
        "word_chars": whole,
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(wordy) - len(set(wordy)),
        "n_repeat_words": again,
        "lost_chars": lost,
        "base_failed": failed,
        "kept": not failed and 100 * lost <= 40 * whole,
    }


def check(df):
    rows = df.withColumn("again", F.col("text")).collect()
    for r in rows:
        assert r["rules"].asDict() == judged(r["again"])
    return rows


PROSE = "The river rose again in the night, and by noon the lower fields near the mill stood under water once more."


def test_lines_that_fail_and_that_stay(spark):
    bad = {
        "boilerplate": ["© 2024 Some House. All rights reserved.", "We use cookies to make this page better for all of you today.", "Please enable JavaScript."],
        "navigation": ["Home", " log in ", "Home | News | Sport", "a » b » c.", "Startseite", "Read more."],
        "punctuation": ["A heading", "### @@@ $$$ *** &&& of.", "BUY!! NOW!! TODAY!!", "short line,"],
    }
    good = [PROSE, "", " \t", "It was late.", "He asked: \"Why?\"", "終わり。", "Done (at last.)", PROSE.rstrip("."), "Rock & roll was all that they played on the radio back in those days."]
    lines = [(x, r) for r, own in bad.items() for x in own] + [(x, None) for x in good]
    df = spark.createDataFrame(lines, "line string, want string").withColumn("got", module.failed_rule(F.col("line")))
    assert [(r["line"], r["got"]) for r in df.collect()] == lines
    assert [rule(x) for x, _ in lines] == [r for _, r in lines]


def test_documents_that_lose_too_much_go(spark):
    body = "\n".join(PROSE.replace("river", w) for w in ("river", "brook", "lake", "sea", "pond"))
    menu = "\n".join(["Home | News | Sport | Weather | Travel | Money"] * 12)
    rows = [(1, body), (2, body + "\nAll rights reserved."), (3, menu + "\n" + body), (4, "word " * 60), (5, PROSE)]
    words = " ".join(f"w{k} x{k}." for k in range(60))
    rows += [(6, words + "\nHome\n" + words.upper())]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r["doc_id"]: r["rules"]["kept"] for r in check(clean_lines(docs))}
    assert kept == {1: False, 2: False, 3: False, 4: False, 5: False, 6: True}
    docs = docs.withColumn("n_chars", F.length("text").cast("long"))
    left = keep_clean(docs).collect()
    assert [(r["doc_id"], r["text"], r["n_chars"]) for r in left] == [(6, words + "\n" + words.upper(), len(words) * 2 + 1)]


@pytest.mark.parametrize("width", [1, 3, 4])
def test_repeated_words(spark, width):
    rng = random.Random(width)
    rows = [([rng.choice("abcd"[: rng.randint(1, 4)]) for _ in range(rng.randint(0, 30))],) for _ in range(120)]
    df = spark.createDataFrame(rows, "w array<string>").withColumn("n", repeated_words(F.col("w"), width))
    for r in df.collect():
        assert r["n"] == repeats(r["w"], width), r


def test_odd_rows(spark):
    rng = random.Random(9)
    parts = ["a", "the", "Home", " ", "\n", "\n", ". ", "| ", "#", "!!", "\t", "\r\n", "é", "\U0001f600", "\u00a0", "\x0b", "\x00", "© 2024"]
    rows = [(k, "".join(rng.choice(parts) for _ in range(rng.randint(0, 300))), "mine", "w") for k in range(80)]
    rows += [(None, None, None, None), (1, "", "x", "x"), (1, "", "x", "x"), (2, "so it is said " * 50_000, "x", "x")]
    rows += [(3, "\n" * 5_000, "x", "x"), (4, '."' * 40_000 + "x", "x", "x"), (5, "!" * 100_000, "x", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, text_ string, words_ string")
    found = check(clean_lines(docs))
    assert len(found) == len(rows) and found[0]["text_"] == "mine" and found[0]["words_"] == "w"
    assert clean_lines(docs.limit(0)).count() == 0
    assert keep_clean(docs).columns == docs.columns
    assert clean_lines(docs.withColumn("rules", F.lit(1))).columns == [*docs.columns, "rules"]


def test_no_python_on_the_path(spark, sf_dir):
    plan = op13_rules(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_query(spark, sf_dir, database):
    df = op13_rules(spark, sf_dir)
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = {r["doc_id"]: r.asDict() for r in df.collect()}
    assert got.keys() == docs.keys()
    for i, row in got.items():
        want = judged(docs[i])
        assert row == {"doc_id": i, **{n: want[n] for n in row if n != "doc_id"}}
    assert compare(df, database, module.SQL["op13_rules"])[0] == "same"


def test_clean_documents_stay(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = op13_rules(spark, sf_dir).filter("NOT base_failed").join(labels, "doc_id").collect()
    assert all(r["kept"] for r in rows if r["quality"] == 1)
    assert not any(r["kept"] for r in rows if r["quality"] == 0)
