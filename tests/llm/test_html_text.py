"""Main text of pages."""

import time

import pytest

from dockwise.llm import html_text as h
from dockwise.llm.block_samples import SAMPLES


def text(page):
    return h.main_text(page, h.trained())


def test_tree_learns_the_labelled_table():
    x, y = h.samples()
    tree = h.trained()
    assert [int(h.decide(tree, row)) for row in x.tolist()] == y.tolist()
    assert len(y) < 200 and x.shape[1] == len(h.FEATURES)


def test_leaving_a_page_out():
    """Pages that the tree has not seen are mostly right."""
    right = total = 0
    for k in range(len(SAMPLES)):
        rest = [s for i, s in enumerate(SAMPLES) if i != k]
        x, y = [], []
        for page, marks in rest:
            x.append(h.features(h.blocks(page)))
            y += [int(c) for c in marks if c in "01"]
        tree = h.grow(h.np.vstack(x), h.np.array(y))
        page, marks = SAMPLES[k]
        got = [h.decide(tree, row) for row in h.features(h.blocks(page)).tolist()]
        want = [c == "1" for c in marks if c in "01"]
        right, total = right + sum(a == b for a, b in zip(got, want)), total + len(want)
    assert right / total > 0.85


def test_best_split_by_brute_force():
    rng = h.np.random.default_rng(2)
    x, y = rng.integers(0, 4, (40, 3)).astype(float), rng.integers(0, 2, 40)
    k, threshold, *_ = h.grow(x, y, depth=1)
    cost = {
        (j, t): h._impurity(y[x[:, j] <= t]) + h._impurity(y[x[:, j] > t]) for j in range(3) for t in (0.5, 1.5, 2.5)
    }
    assert cost[k, threshold] == pytest.approx(min(cost.values()))


NAV = "<nav><ul><li><a href='/'>Home</a></li></ul></nav>"
LONG = "some words that make up a sentence of a certain length and carry no link at all " * 3


@pytest.mark.parametrize(
    "page, want",
    [
        ("", ""),
        ("   ", ""),
        ("<", ""),
        ("<!-- only a comment", ""),
        (f"{NAV}<article><h1>T&amp;T</h1><p>a&nbsp;b\n  c</p><p> </p><p>&eacute;&#233;&#xe9;</p></article>", "T&T\na b c\nééé"),
        (f"{NAV}<article><p>one<b>two</b> three<br>four</p></article>", "onetwo three four"),
        (f"{NAV}<article><p>a<script>var x='</p><p>no';</script>b</p><style>p{{}}</style></article>", "a b"),
        (f"{NAV}<article><p>never closed<p>next <em>one", "never closed\nnext one"),
        (f"<article><p>{LONG}</p><a title='x > y' href=z>more</a><p>cut <a hre", f"{LONG.strip()}\nmore\ncut"),
        (f"{NAV}<article><p>kept</p></article><section id='comments'><p>{LONG}</p></section>", "kept"),
        (f"{NAV}<main><p>kept</p><aside><p>{LONG}</p></aside><form><p>{LONG}</p></form></main>", "kept"),
        (f"<div class='cookie-notice'>{LONG}</div><article><p>kept</p></article><footer><p>{LONG}</p></footer>", "kept"),
        (f"<header><p>{LONG}</p></header><article><header><h1>Title</h1></header><p>kept</p></article>", "Title\nkept"),
    ],
)
def test_pages(page, want):
    assert text(page) == want


def test_operator(spark, sf_dir):
    rows = [(1, None, "x"), (2, "", "x"), (None, f"{NAV}<article><p>a</p></article>", "x"), (2, "<p>" * 50_000 + LONG, "x")]
    df = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = h.extract(df)
    assert got.columns == ["page_id", "html", "text", "n_chars"]
    assert sorted((r["page_id"] or 0, r["text"], r["n_chars"]) for r in got.collect()) == [
        (0, "a", 1), (1, "", 0), (2, "", 0), (2, LONG.strip(), len(LONG.strip())),
    ]
    assert h.extract(df.limit(0)).count() == 0


def test_query(spark, sf_dir):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = h.op5_html(spark, sf_dir).collect()
    assert {r["page_id"] for r in rows} == set(pages) and len(rows) == len(pages)
    for r in rows:
        page = pages[r["page_id"]]
        article = page["html"].split("<article>")[1].split("</article>")[0]
        want = []
        for part in h.re.split(r"</?(?:p|h1)>", article):
            line = " ".join(h.html.unescape(h.re.sub(r"</?b>", "", part.replace("<br>", " "))).split())
            want += [line] if line else []
        assert (r["url"], r["text"], r["n_chars"]) == (page["url"], "\n".join(want), len("\n".join(want)))


@pytest.mark.parametrize(
    "page, want",
    [
        ("<article><p>one</p><svg class=\"i\"/><p>two</p><p>three</p></article>", "one\ntwo\nthree"),
        ("<article><p>one</p><svg class=i><p>two</p><p>three</p></article>", "one\ntwo\nthree"),
        ("<article><p>one</p><datalist><option value=a><option value=b></datalist><p>two</p></article>", "one\ntwo"),
        ("<article><p>one</p><button>no<p>two</p><button>no</button><p>three</p></article>", None),
        ("<article><p title=don't>one</p><p>two</p><p>it's three</p></article>", "one\ntwo\nit's three"),
        (f"{NAV}<div class='content with-sidebar'><article><p>one</p><p>two</p></article></div>", "one\ntwo"),
        (f"{NAV}<div class='search'><main><p>one</p><p>two</p></main></div>", "one\ntwo"),
        (f"{NAV}<article><p>one</p></article><div class='comments'><article><p>{LONG}</p></article></div>", "one"),
    ],
)
def test_ends_that_are_not_written(page, want):
    """Nothing of the article is swallowed up to a later end, quote or the end of the page."""
    got = text(page)
    assert got == want if want is not None else {"two", "three"} <= set(got.split("\n"))


BODY = "<h1>Tools</h1><p>One short line.</p>"


@pytest.mark.parametrize(
    "page, want",
    [
        ("<p>One short line.</p>", "One short line."),
        (f"<html><body>{BODY}<p>{LONG}</p></body></html>", f"Tools\nOne short line.\n{LONG.strip()}"),
        (f"{BODY}<ul><li>a saw</li><li>a plane</li></ul><p>{LONG}</p>", f"Tools\nOne short line.\na saw\na plane\n{LONG.strip()}"),
        (f"{BODY}<pre>x = 1\n  y = 2</pre><p>Done.</p>", "Tools\nOne short line.\nx = 1 y = 2\nDone."),
        (f"<p>{LONG}</p><table><tr><td>mill</td><td>12</td></tr></table>", f"{LONG.strip()}\nmill\n12"),
        (f"<ul><li><a href='/'>Home</a></li><li><a href='/n'>News</a></li></ul>{BODY}<p>{LONG}</p>", f"Tools\nOne short line.\n{LONG.strip()}"),
        (f"{BODY}<div class='sidebar'><p>{LONG}</p></div><footer><p>{LONG}</p></footer>", "Tools\nOne short line."),
        ("<p>a</p><iframe src=x>no</iframe><template><p>no</p></template><noscript>no</noscript><p>b</p>", "a\nb"),
    ],
)
def test_pages_without_article_or_main(page, want):
    assert text(page) == want


@pytest.mark.parametrize("name", ["iframe", "template", "object", "noscript", "button", "svg", "select"])
def test_ends_that_are_not_written_take_linear_time(name):
    begin = time.perf_counter()
    assert "one" in text("<article><p>one</p>" + f"<{name}>x" * 100_000)
    assert "one" in text(f"<article><p>one</p></{name}>" + f"<{name}></{name} " * 30_000)
    assert time.perf_counter() - begin < 20


def test_cut_tags_take_linear_time():
    assert text("<article><p>one</p><a " + "x='y' " * 50_000) == "one"
