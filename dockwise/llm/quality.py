"""Quality of documents: random Fourier features, ridge regression and isotonic calibration."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockwise.llm.common import remainder, table, whole_text
from dockwise.session import settle

#: Labelled documents that the fit uses at most, drawn by a hash of the id.
MAX_LABELLED = 200_000
#: Random Fourier features, the ridge penalty per document, the seed of the frequencies.
FREQUENCIES, RIDGE, SEED = 256, 1e-4, 3
#: Parts that the sample is summed in, and bins of raw scores for calibration.
PARTS, BINS = 16, 1_000
#: A document is good from this score on.
ACCEPT = 0.7

STATISTICS = (
    "chars words mean_word long_words letters upper digits space other_ascii non_ascii symbol_ends distinct top_word "
    "top_ten repeated_pairs lines mean_line repeated_lines capital_words bare_words sentence_ends distinct_letters"
).split()
_KIND = np.zeros(256, dtype=np.int64)  # 0 other ASCII, 1 upper, 2 lower, 3 digit, 4 space, 5 beyond ASCII
_KIND[65:91], _KIND[97:123], _KIND[48:58], _KIND[[9, 10, 11, 12, 13, 32]], _KIND[128:] = 1, 2, 3, 4, 5


def statistics(text: str) -> list[float]:
    """Numbers that describe a whole text, one per name in STATISTICS; an empty text gives zeros."""
    raw = text.encode("utf-8", "replace")
    if not raw:
        return [0.0] * len(STATISTICS)
    used = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    kinds = np.bincount(_KIND, weights=used, minlength=6) / len(raw)
    words = raw.split()
    n = max(1, len(words))
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    counts = Counter(words)
    common = counts.most_common(10)
    pairs = len(set(zip(words, words[1:])))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    ends = Counter(w[-1] for w in words)
    plain_end = sum(c for b, c in ends.items() if _KIND[b] in (1, 2, 3, 5) or b in b".,;:?\"')")
    bare = sum(c for w, c in counts.items() if not any(_KIND[b] in (1, 2, 3, 5) for b in w))
    capital = sum(c for w, c in counts.items() if len(w) > 1 and w.upper() == w and w.lower() != w)
    letters = used[97:123] + used[65:91]
    share = letters[letters > 0] / max(1, letters.sum())
    return [
        float(np.log1p(len(raw))),
        float(np.log1p(len(words))),
        float(sizes.mean()) if len(words) else 0.0,
        float((sizes > 12).mean()) if len(words) else 0.0,
        float(kinds[1] + kinds[2]),
        float(kinds[1]),
        float(kinds[3]),
        float(kinds[4]),
        float(kinds[0]),
        float(kinds[5]),
        1.0 - plain_end / n,
        len(counts) / n,
        common[0][1] / n if common else 0.0,
        sum(c for _, c in common) / n,
        1.0 - pairs / max(1, len(words) - 1) if len(words) > 1 else 0.0,
        float(np.log1p(len(lines))),
        float(np.log1p(len(raw) / max(1, len(lines)))),
        1.0 - len(set(lines)) / max(1, len(lines)),
        capital / n,
        bare / n,
        sum(ends.get(b, 0) for b in b".?!") / n,
        float(-(share * np.log(share)).sum()),
    ]


def document_statistics(text_col: str = "text") -> Column:
    """The statistics of a text column as an array; null counts as empty."""

    @F.pandas_udf("array<double>")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([statistics(t) for t in texts])

    return found(whole_text(text_col))


@dataclass
class Quality:
    """A fitted model: standardised statistics, cosine features, weights, calibration."""

    mean: np.ndarray
    scale: np.ndarray
    frequency: np.ndarray
    phase: np.ndarray
    weight: np.ndarray | None = None
    raw: np.ndarray | None = None
    good: np.ndarray | None = None

    def features(self, stats: np.ndarray) -> np.ndarray:
        """Random Fourier features of a Gaussian kernel, and a constant."""
        x = np.clip((stats - self.mean) / self.scale, -8, 8)
        z = np.sqrt(2 / len(self.phase)) * np.cos(x @ self.frequency + self.phase)
        return np.column_stack([z, np.ones(len(z))])

    def raw_score(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weight

    def score(self, stats: np.ndarray) -> np.ndarray:
        """Calibrated share of good documents, 0 to 1."""
        return np.clip(np.interp(self.raw_score(stats), self.raw, self.good), 0.0, 1.0)


def pool_adjacent(value: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Isotonic regression: the rising values nearest to `value` in weighted squares."""
    pools: list[list[float]] = []  # mean, weight, length
    for v, w in zip(value.tolist(), weight.tolist()):
        pools.append([v, w, 1])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            v2, w2, n2 = pools.pop()
            v1, w1, n1 = pools[-1]
            pools[-1] = [(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2]
    return np.concatenate([np.full(n, v) for v, _, n in pools]) if pools else np.array([])


def _stack(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype=np.float64).reshape(len(column), len(STATISTICS))


def fit(labelled: DataFrame, most: int = MAX_LABELLED) -> Quality:
    """The model of labelled rows (doc_id, stats, quality 0 or 1).

    At most `most` rows are used, drawn by a hash of the id; all else covers what is given.
    Three quarters of the rows, by another hash, give the ridge weights: every part sums
    its normal equations and the sums are added. The last quarter calibrates: the share of
    good documents per bin of raw scores, made rising by pooling adjacent violators. With
    no rows the score is 1 for every document, with one label its share.
    """
    total = labelled.count()
    if total > most:
        labelled = labelled.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) < int((1 << 40) * most / total))
    dims = len(STATISTICS)
    rng = np.random.default_rng(SEED)
    frequency, phase = rng.normal(0, 1 / np.sqrt(dims), (dims, FREQUENCIES)), rng.uniform(0, 2 * np.pi, FREQUENCIES)
    sample = settle(
        labelled.select(
            "stats", F.col("quality").cast("double").alias("y"), (F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(4)) == 3).alias("last")
        ).repartition(PARTS)
    )
    moments = sample.select(F.posexplode("stats").alias("k", "x")).groupBy("k")
    moments = moments.agg(F.avg("x").alias("mean"), F.stddev_pop("x").alias("scale")).orderBy("k").collect()
    if not moments:
        flat = Quality(np.zeros(dims), np.ones(dims), frequency, phase, np.zeros(FREQUENCIES + 1))
        flat.raw, flat.good = np.array([0.0]), np.array([1.0])
        return flat
    mean = np.array([m["mean"] for m in moments])
    scale = np.array([m["scale"] if m["scale"] > 1e-9 else 1.0 for m in moments])
    model = Quality(mean, scale, frequency, phase)
    size = FREQUENCIES + 1

    def equations(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gram, right, n = np.zeros((size, size)), np.zeros(size), 0
        for batch in batches:
            for at in range(0, len(batch), 4096):
                part = batch.iloc[at : at + 4096]
                z = model.features(_stack(part["stats"]))
                gram += z.T @ z
                right += z.T @ part["y"].to_numpy()
                n += len(part)
        yield pd.DataFrame({"gram": [gram.tobytes()], "right": [right.tobytes()], "n": [n]})

    gram, right, n = np.zeros((size, size)), np.zeros(size), 0
    first = sample.filter("NOT last").select("stats", "y").coalesce(PARTS)
    for row in first.mapInPandas(equations, "gram binary, right binary, n long").toLocalIterator():  # PARTS rows
        gram += np.frombuffer(row["gram"]).reshape(size, size)
        right += np.frombuffer(row["right"])
        n += row["n"]
    ridge = np.eye(size) * RIDGE * max(1, n)
    ridge[-1, -1] = 1e-9
    model.weight = np.linalg.solve(gram + ridge, right)

    @F.pandas_udf("double")
    def raw(stats: pd.Series) -> pd.Series:
        return pd.Series(model.raw_score(_stack(stats)))

    # with few rows there may be no last quarter; then all rows calibrate
    last = sample.filter("last")
    last = sample if last.isEmpty() else last
    binned = last.select(raw("stats").alias("raw"), "y").withColumn("bin", F.floor(F.col("raw") * (BINS / 4)))
    binned = binned.withColumn("bin", F.greatest(F.lit(-BINS), F.least(F.lit(BINS), "bin")))
    rows = sorted(
        tuple(r) for r in binned.groupBy("bin").agg(F.avg("raw"), F.avg("y"), F.count("*")).collect()  # 2 * BINS at most
    )
    model.raw = np.array([r[1] for r in rows])
    model.good = pool_adjacent(np.array([r[2] for r in rows]), np.array([r[3] for r in rows], dtype=float))
    return model


def labelled_rows(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (doc_id, stats, quality) to learn from: those whose crc32(id) mod 4 is not 2.

    Labels other than 0 and 1 and null ids are left out; an id with both labels is left out;
    an id that repeats gives one row per document row.
    """
    good = labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    good = good.agg(F.min("quality").alias("quality"), F.max("quality").alias("most")).filter("quality = most").drop("most")
    return stats.join(good, "doc_id").filter(~held_out())


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that no label is learned from; a null id counts as held out."""
    return F.coalesce(remainder(id_col, 4) == 2, F.lit(True))


def score(model: Quality, stats: Column) -> Column:
    """The calibrated score, 0 to 1, of a column of statistics; nothing else is looked at."""

    @F.pandas_udf("double")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(model.score(_stack(batch)))

    return found(stats)


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, Quality]:
    """Statistics of all rows (doc_id, stats), and the model that the labels give."""
    stats = settle(docs.select(F.col(id_col).cast("long").alias("doc_id"), document_statistics(text_col).alias("stats")))
    return stats, fit(labelled_rows(stats, labels))


def keep_good(docs: DataFrame, labels: DataFrame, accept: float = ACCEPT, text_col: str = "text") -> DataFrame:
    """The rows of docs with a score of at least `accept`; columns stay as they are.

    Every row is judged by its own whole text, so repeated ids and null ids are handled
    like any; a null text counts as empty.
    """
    _, model = learn(docs, labels, text_col=text_col)
    return docs.filter(score(model, document_statistics(text_col)) >= accept)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats, model = learn(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    found = stats.withColumn("score", score(model, F.col("stats")))
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted"))


QUERIES = {"op6_quality": op6_quality}
