"""Main text of web pages: flat text blocks classified by a small decision tree."""

from __future__ import annotations

import functools
import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockwise.llm.block_samples import SAMPLES
from dockwise.llm.common import table, whole_text

#: Attributes of a tag; a quoted value begins only after an equals sign.
ATTRIBUTES = r"(?:[^>=]++|=\s*+(?:\"[^\"]*\"|'[^']*')?+)*+"
#: Markup in order: comments, elements whose content is no text, tags, declarations, and a
#: tag that the page breaks off. Only comments and raw text may run to the end of the page;
#: of other elements an end must be written, else the start is a tag like any.
MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?:(?P<raw>script|style|title|textarea)\b{ATTRIBUTES}>.*?(?:</(?P=raw)\s*>|\Z)"
    rf"|svg\b{ATTRIBUTES}(?<=/)>"
    rf"|option\b{ATTRIBUTES}>[^<]*"
    rf"|(?P<inside>select|button|svg)\b{ATTRIBUTES}>(?:[^<]|<(?!/?(?:p|h[1-6]|article|main|section)\b|(?P=inside)\b))*?</(?P=inside)\s*>)"
    rf"|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9-]*)(?P<attributes>{ATTRIBUTES})>"
    r"|<[!?][^>]*>"
    r"|<[a-zA-Z/!?][^>]*\Z",
    re.DOTALL | re.IGNORECASE,
)
#: Elements that hold no text of the page where their end is written; where it is not, they are tags like any.
HELD = {name: re.compile(rf"</{name}\s*>", re.IGNORECASE) for name in ("noscript", "template", "iframe", "object")}
HINTS = re.compile(r"""(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.IGNORECASE)

#: Fixed values of HTML: elements inside a line; all others end a text block.
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark "
    "q s samp small span strike strong sub sup time tt u var wbr".split()
)
CONTAINERS = set(
    "article main nav aside header footer form menu section div ul ol dl table tbody thead tr td th "
    "figure details dialog fieldset blockquote body".split()
)
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Elements that hold running text; a div or a section may hold anything.
TEXTUAL = {"p", "li", "td", "th", "pre", "blockquote", "dd", "dt", "figcaption", "caption", *HEADINGS}
MAIN = {"article", "main"}
ASIDE = {"nav", "aside", "footer", "form", "menu", "dialog"}
#: Words in class, id or role that name something beside the main text.
ASIDE_HINTS = set(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion menu nav navbar navigation "
    "breadcrumb breadcrumbs sidebar aside footer masthead cookie cookies consent notice notices alert popup modal overlay "
    "comment comments reply replies respond disqus share sharing social related recommended newsletter subscribe signup "
    "login search widget pagination pager toolbar copyright legal disclaimer skip complementary contentinfo".split()
)
#: Of these, words for texts of others, which stay beside the main text even where they are articles.
OTHERS_HINTS = set("comment comments reply replies respond disqus related recommended".split())
#: A class such as with-sidebar tells of the page's layout and does not name the element.
LAYOUT = re.compile(r"\b(?:with|without|has|no)[-_]+[a-z_-]+")


@dataclass
class Block:
    """A run of text between block elements."""

    text: str
    words: int
    link_words: int
    main: bool
    aside: bool
    heading: bool
    textual: bool


def blocks(page: str) -> list[Block]:
    """Text blocks of a page in order; markup may be broken or cut off anywhere."""
    found: list[Block] = []
    parts: list[str] = []
    link_parts: list[str] = []
    # container, inside main, inside something beside it, which a nested article does not undo
    stack: list[tuple[str, bool, bool, bool]] = []
    heading = link = False
    element = ""
    at = 0
    last_end: dict[str, int] = {}  # where the last written end of a held element begins

    def close() -> None:
        nonlocal parts, link_parts
        words = "".join(parts).split()
        if words:
            _, main, aside, _ = stack[-1] if stack else ("", False, False, False)
            found.append(Block(" ".join(words), len(words), len("".join(link_parts).split()), main, aside, heading, element in TEXTUAL))
        parts, link_parts = [], []

    def text(until: int) -> None:
        if until > at:
            piece = html.unescape(page[at:until])
            parts.append(piece)
            if link:
                link_parts.append(piece)

    while hit := MARKUP.search(page, at):
        text(hit.start())
        at = hit.end()
        name = hit["name"]
        if not name:
            if page[hit.start() + 1] not in "!?":
                parts.append(" ")
            continue
        name = name.lower()
        ending = hit["end"] == "/"
        if name in HELD and not ending:
            if name not in last_end:
                last_end[name] = max((m.start() for m in HELD[name].finditer(page, at)), default=-1)
            if last_end[name] >= at:  # a page without such an end is searched once
                at = HELD[name].search(page, at).end()
                parts.append(" ")
                continue
        if name in INLINE:
            if name == "a":
                link = not ending
                link_parts.append(" ")
            elif name in ("br", "img", "wbr"):
                parts.append(" ")
            continue
        close()
        link = False
        if name in HEADINGS:
            heading = not ending
        if not ending:
            element = name
        if name not in CONTAINERS:
            if ending:
                element = stack[-1][0] if stack else ""
            continue
        if ending:
            if any(entry[0] == name for entry in stack):
                while stack.pop()[0] != name:
                    pass
            heading = False
            element = stack[-1][0] if stack else ""
        elif not hit["attributes"].endswith("/"):
            _, main, aside, firm = stack[-1] if stack else ("", False, False, False)
            values = (LAYOUT.sub(" ", m.group(1).lower()) for m in HINTS.finditer(hit["attributes"]))
            hints = {w for value in values for w in re.split(r"[^a-z]+", value)}
            beside = name in ASIDE or (name == "header" and not main) or not hints.isdisjoint(ASIDE_HINTS)
            if name in MAIN:
                aside = firm or (aside and main)
            elif name != "body":
                aside = aside or beside
                firm = firm or name in ASIDE or not hints.isdisjoint(OTHERS_HINTS)
            stack.append((name, main or name in MAIN, aside, firm))
    text(len(page))
    close()
    return found


FEATURES = (
    "words link_density words_before link_density_before words_after link_density_after in_main beside heading textual page_has_main"
).split()


def features(found: list[Block]) -> np.ndarray:
    """One row per block: its words and link density, those of its neighbours, its place."""
    words = np.array([0, *(b.words for b in found), 0], dtype=float)
    density = np.array([0, *(b.link_words / b.words for b in found), 0], dtype=float)
    marks = np.array([(b.main, b.aside, b.heading, b.textual) for b in found], dtype=float).reshape(len(found), 4)
    has_main = np.full(len(found), float(any(b.main for b in found)))
    return np.column_stack(
        [words[1:-1], density[1:-1], words[:-2], density[:-2], words[2:], density[2:], marks, has_main]
    )


def _impurity(label: np.ndarray) -> float:
    share = label.mean() if len(label) else 0.0
    return 2 * share * (1 - share) * len(label)


def grow(x: np.ndarray, y: np.ndarray, depth: int = 6, least: int = 1):
    """A decision tree by Gini impurity: (feature, threshold, low branch, high branch) or a label.

    Ties take the first feature and the lowest threshold, so the tree is reproducible.
    """
    if depth == 0 or y.min() == y.max():
        return bool(2 * y.sum() > len(y))
    best = (_impurity(y) - 1e-9, None)
    for k in range(x.shape[1]):
        values = np.unique(x[:, k])
        for threshold in (values[1:] + values[:-1]) / 2:
            low = x[:, k] <= threshold
            if least <= low.sum() <= len(y) - least:
                cost = _impurity(y[low]) + _impurity(y[~low])
                if cost < best[0] - 1e-9:
                    best = (cost, (k, threshold))
    if best[1] is None:
        return bool(2 * y.sum() > len(y))
    k, threshold = best[1]
    low = x[:, k] <= threshold
    return k, float(threshold), grow(x[low], y[low], depth - 1, least), grow(x[~low], y[~low], depth - 1, least)


def samples() -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the labelled pages."""
    x, y = [], []
    for page, marks in SAMPLES:
        found = blocks(page)
        labels = [int(c) for c in marks if c in "01"]
        if len(found) != len(labels):
            raise ValueError(f"{len(found)} blocks but {len(labels)} marks: {page[:80]}")
        x.append(features(found))
        y += labels
    return np.vstack(x), np.array(y)


@functools.cache
def trained():
    """The tree that the labelled table gives."""
    return grow(*samples())


def decide(tree, row) -> bool:
    while not isinstance(tree, bool):
        k, threshold, low, high = tree
        tree = low if row[k] <= threshold else high
    return tree


def main_text(page: str, tree) -> str:
    """The blocks that the tree calls main text, in page order, joined by newlines."""
    found = blocks(page)
    if not found:
        return ""
    return "\n".join(b.text for b, row in zip(found, features(found).tolist()) if decide(tree, row))


def extract(pages: DataFrame, html_col: str = "html", tree=None) -> DataFrame:
    """The rows of pages with two more columns: text (empty if there is none) and n_chars.

    A page is cut into flat text blocks at block elements; a block's word count and link
    density, those of its neighbours and its surroundings decide by the tree whether it
    is main text. Character references are decoded and white space inside a block becomes
    one space. Whole pages are read; a null page counts as empty, broken or cut markup is
    read as far as it goes. Columns named text or n_chars are replaced, others pass.
    """
    tree = trained() if tree is None else tree

    @F.pandas_udf("string")
    def text_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(page, tree) for page in batch], dtype=object)

    found = pages.withColumn("text", text_of(whole_text(html_col)))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")


QUERIES = {"op5_html": op5_html}
