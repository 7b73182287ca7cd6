"""Pieces that several operators of this package share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockwise.session import settle

#: ASCII white space as a Java character class: space and TAB to CR.
WHITE = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """A text column in which null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def remainder(column: str, modulus: int) -> Column:
    """CRC-32 of an id written as text, modulo a number; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def free_name(columns: list[str], name: str) -> str:
    """A helper column's name that none of the given columns has, in either case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def components(links: DataFrame, rounds: int = 40) -> DataFrame:
    """Connected components of an edge list (a long, b long): rows (node, component_id).

    component_id is the smallest node reachable. Alternating large-star and small-star
    steps: every step is an aggregate and a join on node, nothing is collected, and each
    round is written to the shared folder, so lineage stays short. A node with very many
    neighbours is met only by partial minima and by a join that can be split. Null ends
    and self links are left out; an empty list gives an empty table.
    """
    edges = settle(
        links.filter("a <> b")
        .select(F.greatest("a", "b").cast("long").alias("u"), F.least("a", "b").cast("long").alias("v"))
        .distinct()
    )
    before = None
    for _ in range(rounds):
        # large star: all larger neighbours of u are linked to the smallest one around u
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        ).distinct()
        # small star: u and its smaller neighbours are linked to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        edges = settle(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        now = edges.agg(
            F.count("*").alias("n"),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"),
        ).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component_id")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component_id")).unionByName(roots)


def whole_groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Regroups the batches of a task sorted by `keys` so that no group is cut in two.

    Only the rows of the last, still open group are held back. Use it where a group is bounded.
    """
    rest = None
    for batch in batches:
        if not len(batch):
            continue
        if rest is not None:
            batch = pd.concat([rest, batch], ignore_index=True)
        last = batch.iloc[-1]
        open_ = np.logical_and.reduce([(batch[k] == last[k]).to_numpy() for k in keys])
        cut = len(batch) - int(open_.sum())
        rest = batch.iloc[cut:]
        if cut:
            yield batch.iloc[:cut]
    if rest is not None:
        yield rest


def group_edges(rows: pd.DataFrame, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the groups in rows sorted by `keys`."""
    change = np.zeros(len(rows), dtype=bool)
    change[:1] = True
    for k in keys:
        column = rows[k].to_numpy()
        change[1:] |= column[1:] != column[:-1]
    starts = np.flatnonzero(change)
    return starts, np.append(starts[1:], len(rows))
