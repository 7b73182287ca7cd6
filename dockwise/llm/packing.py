"""Length buckets with the least padding, and batches of a token budget inside them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from dockwise.llm.common import table, whole_text
from dockwise.session import settle

#: Buckets, and tokens of a batch with its padding.
BUCKETS = 8
BUDGET = 65_536
#: Lengths up to here have a histogram bin each; beyond, bins grow by 1/256 of the length,
#: so a 64-bit length falls into fewer than 12,000 bins.
FINE = 1_024
#: Ids that are numbered together; a run of ids of one length holds no more rows than this.
RUN = 8_192


def length_bin(length: Column) -> Column:
    """The histogram bin of a length; bins are ordered as lengths are."""
    octave = F.length(F.bin(length)) - 1
    within = F.call_function("shiftright", length, octave - 8) - 256
    return F.when(length < FINE, length).otherwise(FINE + (octave - 10) * 256 + within).cast("int")


def best_boundaries(top: np.ndarray, rows: np.ndarray, tokens: np.ndarray, buckets: int) -> list[int]:
    """Upper lengths of at most `buckets` buckets that minimise padding.

    top, rows, tokens: longest length, rows and tokens of each histogram bin, in order.
    Dynamic programming over the bins: the best padding of the first j bins in k buckets is
    the least over the last cut i of that of i bins in k - 1 buckets plus the padding of
    bins i to j under the boundary top[j]. Ties take the smallest cut.
    """
    n = len(top)
    if not n:
        return []
    count = np.concatenate([[0], np.cumsum(rows, dtype=np.float64)])
    total = np.concatenate([[0], np.cumsum(tokens, dtype=np.float64)])
    best = np.full(n + 1, np.inf)
    best[0] = 0
    cuts = []
    for _ in range(min(buckets, n)):
        after = np.full(n + 1, np.inf)
        cut = np.zeros(n + 1, dtype=int)
        for j in range(1, n + 1):
            padding = best[:j] + top[j - 1] * (count[j] - count[:j]) - (total[j] - total[:j])
            cut[j] = int(np.argmin(padding))
            after[j] = padding[cut[j]]
        after[0] = 0
        cuts.append(cut)
        best = after
    bounds, j = [], n
    for cut in reversed(cuts):
        if not j:
            break
        bounds.append(int(top[j - 1]))
        j = cut[j]
    return sorted(set(bounds))


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS, budget: int = BUDGET
) -> DataFrame:
    """One row per input row: id, n_tokens, bucket, padded_length, batch, slot.

    Tokens are the words of the whole text (runs without ASCII white space) and one end.
    The histogram of all lengths fixes the bucket boundaries: dynamic programming finds
    those with the least padding (exact for lengths below FINE; above, boundaries lie at
    the longest length of a histogram bin of 1/256). A row belongs to the first bucket
    whose padded_length holds it. Inside a bucket rows are ordered by length and id and cut
    into batches of max(1, budget // padded_length) rows, so a batch with its padding keeps
    to the budget; a longer text is a batch of its own and is never cut. batch counts from
    0 in its bucket, slot from 0 in its batch. Null texts are empty (length 1); rows with a
    null id come first; of rows that repeat an id and a length any order is the same to all
    columns but slot and batch. An empty table gives an empty result.

    At scale: the histogram is a partial aggregate of fewer than 12,000 bins. A row's place
    is the number of shorter rows, plus those of its length in earlier runs of ids, plus
    its rank in its own run, so that a length that a third of all rows share is numbered in
    many tasks.
    """
    words = F.regexp_count(whole_text(text_col), F.lit(r"[^\x20\x09-\x0D]+"))
    rows = settle(docs.select(F.col(id_col).cast("long").alias("doc_id"), (words + 1).cast("long").alias("n_tokens")))
    rows = rows.withColumn("bin", length_bin(F.col("n_tokens"))).withColumn(
        "run", F.coalesce(F.floor(F.col("doc_id") / RUN), F.lit(-(2**62)))
    )
    runs = settle(rows.groupBy("bin", "n_tokens", "run").agg(F.count("*").alias("rows")))
    lengths = runs.groupBy("bin", "n_tokens").agg(F.sum("rows").alias("rows"))
    bins = lengths.groupBy("bin").agg(
        F.max("n_tokens").alias("top"), F.sum("rows").alias("rows"), F.sum(F.col("n_tokens") * F.col("rows")).alias("tokens")
    )
    found = sorted(tuple(r) for r in bins.collect())  # fewer than 12,000 bins
    bounds = best_boundaries(*(np.array([r[k] for r in found], dtype=np.float64) for k in (1, 2, 3)), buckets)

    number = F.lit(0)
    padded = F.lit(None).cast("long")
    for k, bound in reversed(list(enumerate(bounds))):
        number = F.when(F.col("n_tokens") <= bound, k).otherwise(number)
        padded = F.when(F.col("n_tokens") <= bound, F.lit(bound).cast("long")).otherwise(padded)
    # rows before a bin and before a length in its bin, then before a run in its length
    before = {}
    place = {b: 0 for b in bounds}
    for _, top, n, _ in found:
        bound = next(b for b in bounds if b >= top)
        before[_bin(top)] = place[bound]
        place[bound] += n
    spark = docs.sparkSession
    starts = spark.createDataFrame([(b, int(n)) for b, n in before.items()], "bin int, bin_start long")
    in_bin = W.partitionBy("bin").orderBy("n_tokens").rowsBetween(W.unboundedPreceding, -1)
    in_length = W.partitionBy("n_tokens").orderBy("run").rowsBetween(W.unboundedPreceding, -1)
    lengths = lengths.withColumn("length_start", F.coalesce(F.sum("rows").over(in_bin), F.lit(0)))
    lengths = lengths.join(F.broadcast(starts), "bin")  # one row per bin
    runs = runs.withColumn("run_start", F.coalesce(F.sum("rows").over(in_length), F.lit(0))).join(
        lengths.select("n_tokens", (F.col("bin_start") + F.col("length_start")).alias("first")), "n_tokens"
    )
    rank = F.row_number().over(W.partitionBy("n_tokens", "run").orderBy("doc_id")) - 1
    placed = rows.join(
        runs.select("n_tokens", "run", (F.col("first") + F.col("run_start")).alias("start")), ["n_tokens", "run"]
    )
    placed = placed.withColumn("place", F.col("start") + rank).withColumn("bucket", number).withColumn("padded_length", padded)
    room = F.greatest(F.lit(1).cast("long"), F.floor(F.lit(budget) / F.col("padded_length")))
    return placed.select(
        F.col("doc_id").alias(id_col),
        "n_tokens",
        F.col("bucket").cast("int").alias("bucket"),
        "padded_length",
        F.floor(F.col("place") / room).cast("long").alias("batch"),
        (F.col("place") % room).cast("long").alias("slot"),
    )


def _bin(length: int) -> int:
    """`length_bin` of one length."""
    length = int(length)
    if length < FINE:
        return length
    octave = length.bit_length() - 1
    return FINE + (octave - 10) * 256 + (length >> (octave - 8)) - 256


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


QUERIES = {"op9_packing": op9_packing}
