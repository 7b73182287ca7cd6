"""Secrets in texts: fixed patterns, and random strings that a token vocabulary betrays."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockwise.llm.common import free_name, table, whole_text

#: The base patterns and their least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # the pattern's runs of 20 characters and more
HEX = re.compile(r"[0-9a-f]{24,}")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN_LENGTH = 6

#: Lengths of the hexadecimal digests in common use, and the layout of a UUID.
DIGESTS = {32, 40, 56, 64, 96, 128}
UUID = re.compile(r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
ONLY_HEX = re.compile(r"[0-9a-f]+|[0-9A-F]+")

#: Runs that the token test looks at, and the ratio of characters to tokens below which a
#: run counts as random. Words and identifiers of letters lie well above.
RUN = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
RATIO = 2.0
#: Parts of a run, a UUID being one, and the least length of a random string among them.
PART = re.compile(rf"(?<![A-Za-z0-9]){UUID.pattern}(?![A-Za-z0-9])|[A-Za-z0-9]+=*")
LEAST = 16

KINDS = ("assign", "access", "hex", "random")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, rank of the kind, end) of the base kinds, leftmost and non-overlapping per kind."""
    found = []
    low = text.lower()
    if any(word in low for word in KEYWORDS) or not text.isascii():
        for hit in ASSIGN.finditer(text):
            if hit.end(2) - hit.start(2) >= ASSIGN_LENGTH:
                found.append((hit.start(), 0, hit.end()))
    if "AKIA" in text:
        found.extend((hit.start(), 1, hit.end()) for hit in ACCESS.finditer(text))
    found.extend((hit.start(), 2, hit.end()) for hit in HEX.finditer(text))
    return found


def plain_identifier(run: str) -> bool:
    """Digests, UUIDs and numbers are known shapes, not secrets; words are told by the ratio."""
    if UUID.fullmatch(run) or (len(run) in DIGESTS and ONLY_HEX.fullmatch(run)):
        return True
    return not any(c.isalpha() for c in run)


def random_spans(text: str, encoding, ratio: float = RATIO) -> list[tuple[int, int, int]]:
    """Runs, or else stretches of their parts, whose characters per token stay below `ratio`.

    Known shapes are left out. A run that is not random as a whole, such as a path, is
    searched for neighbouring parts that all are.
    """

    def dense(part: str) -> bool:
        return len(part) < ratio * len(encoding.encode_ordinary(part))

    found = []
    for hit in RUN.finditer(text):
        run, start = hit.group(), hit.start()
        if plain_identifier(run):
            continue
        if dense(run):
            found.append((start, 3, hit.end()))
            continue
        stretches, follows = [], False
        for part in PART.finditer(run):
            word = part.group()
            known = plain_identifier(word) and not word.isdigit()
            fits = not known and dense(word)
            if fits and follows:
                stretches[-1][1] = part.end()
            elif fits:
                stretches.append([*part.span()])
            follows = fits
        for a, b in stretches:
            if b - a >= LEAST and not plain_identifier(run[a:b]) and dense(run[a:b]):
                found.append((start + a, 3, start + b))
    return found


_ENCODINGS: dict[str, object] = {}


def encoding_of(path: str, pattern: str):
    """A tiktoken vocabulary from its file of ranks, read once per worker."""
    if path not in _ENCODINGS:
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in file)}
        _ENCODINGS[path] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _ENCODINGS[path]


def default_vocabulary() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


SPANS = "array<struct<kind:string,start:int,end:int>>"


def find_secrets(docs: DataFrame, text_col: str = "text", vocabulary=None, ratio: float = RATIO) -> DataFrame:
    """The rows of docs with one more column `secret_spans`, an array of (kind, start, end).

    Spans are in code points, the end exclusive, by start and then by kind as listed in
    KINDS. The kinds assign, access and hex follow fixed patterns. The kind random is the
    token-efficiency test: a run of 16 or more characters that needs more than one token per
    `ratio` characters is a random string, and so is a stretch of parts of such length inside
    a path or a joined name; digests, UUIDs and plain numbers are left out. All of a text is searched, whatever its length; null is
    empty and has no spans. Ids are not looked at, so null and repeated ids pass; a column
    of the name `secret_spans` is replaced.
    """
    path, pattern = vocabulary or default_vocabulary()

    @F.pandas_udf(SPANS)
    def spans(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoding = encoding_of(path, pattern)
        for texts in batches:
            yield pd.Series(
                [
                    [
                        {"kind": KINDS[kind], "start": a, "end": b}
                        for a, kind, b in sorted(base_spans(t) + random_spans(t, encoding, ratio))
                    ]
                    for t in texts
                ]
            )

    return docs.withColumn("secret_spans", spans(whole_text(text_col)))


def redacted(text: str, spans: list[tuple[int, int]], mark: str) -> str:
    """The text with each run of overlapping spans replaced by a mark."""
    out, at = [], 0
    for start, end in sorted(spans):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]", vocabulary=None, ratio: float = RATIO) -> DataFrame:
    """The rows of docs with the spans of `find_secrets` in the text replaced by a mark.

    Texts without a span, null ones too, stay as they are; so do all other columns but
    n_chars, which is set to the new length of a changed text where docs has it.
    """
    path, pattern = vocabulary or default_vocabulary()

    @F.pandas_udf("string")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoding = encoding_of(path, pattern)
        for texts in batches:
            found = ([(a, b) for a, _, b in base_spans(t) + random_spans(t, encoding, ratio)] for t in texts)
            yield pd.Series([redacted(t, s, mark) if s else None for t, s in zip(texts, found)], dtype=object)

    cleaned = free_name(docs.columns, "clean")
    rows = docs.withColumn(cleaned, clean(whole_text(text_col)))
    changed = {text_col: F.coalesce(cleaned, F.col(text_col))}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col(cleaned).isNull(), F.col("n_chars")).otherwise(
            F.length(cleaned).cast(docs.schema["n_chars"].dataType)
        )
    return rows.withColumns(changed).select(docs.columns)


def _joined(spans) :
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.col("secret_spans")

    def count(kind: str):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter(spans, lambda s: s["kind"] != "random")
    found = find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "secret_spans")
    return found.select(
        "doc_id",
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"),
        _joined(spans).alias("spans"),
    )


QUERIES = {"op8_secrets": op8_secrets}
