"""Near-duplicates by SimHash fingerprints, found through pigeonring filtering."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockwise.llm.common import components, free_name, group_edges, table, whole_groups, whole_text
from dockwise.session import settle

#: Fingerprints of one key that a task compares; larger groups are cut into blocks.
BLOCK = 20_000
#: Pairs that are laid out at once in memory.
PAIRS = 1_000_000


def fingerprint(text: str, words: int, seeds: tuple[int, ...]) -> list[int]:
    """SimHash of word shingles, one 64-bit number per seed; zeros for a text without words."""
    parts = text.encode("utf-8", "replace").lower().split()
    if not parts:
        return [0] * len(seeds)
    line = b" ".join(parts)
    starts = list(itertools.accumulate((len(p) + 1 for p in parts), initial=0))
    last = max(1, len(parts) - words + 1)
    ends = starts[min(words, len(parts)) :]
    shingles = [line[a : b - 1] for a, b in zip(starts[:last], ends)]
    found = []
    for seed in seeds:
        count = np.zeros(64, dtype=np.int64)
        for at in range(0, last, 65_536):  # bounds the memory for very long texts
            hashes = np.array([xxhash.xxh64_intdigest(s, seed) for s in shingles[at : at + 65_536]], dtype="<u8")
            bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            count += bits.sum(axis=0, dtype=np.int64)
        found.append(int(np.packbits(2 * count > last, bitorder="little").view("<u8")[0]))
    return found


def _as_long(values) -> np.ndarray:
    return np.array(values, dtype=np.uint64).view(np.int64)


def fingerprints(docs: DataFrame, id_col: str, text_col: str, words: int, seeds: tuple[int, ...]) -> DataFrame:
    """Rows (doc_id, fp, fp2): a second fingerprint only where two seeds are given, else 0."""

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            prints = [fingerprint(t, words, seeds) for t in batch["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "fp": _as_long([p[0] for p in prints]),
                    "fp2": _as_long([p[-1] if len(seeds) > 1 else 0 for p in prints]),
                }
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    return rows.mapInPandas(of, "doc_id long, fp long, fp2 long")


def segments(radius: int, bits: int = 64) -> list[tuple[int, int]]:
    """(shift, width) of radius + 1 segments that cover the fingerprint."""
    n = radius + 1
    edges = [bits * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _chain_masks(radius: int) -> list[list[np.uint64]]:
    """For each start, the bits of the first 1, 2, ... segments of its chain on the ring."""
    masks = [((1 << w) - 1) << s for s, w in segments(radius)]
    n = len(masks)
    return [
        [np.uint64(m) for m in itertools.accumulate((masks[(i + k) % n] for k in range(n)), lambda a, b: a | b)]
        for i in range(n)
    ]


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A link from every node to the smallest node of its component; one row per node at most."""
    if not len(a):
        return a, b
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[left], label[right])
        after = label.copy()
        for end in (left, right, label[left], label[right]):
            np.minimum.at(after, end, low)
        while not np.array_equal(after, after[after]):
            after = after[after]
        if np.array_equal(after, label):
            break
        label = after
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


class _Group:
    """Fingerprints that share a key, index rows first."""

    def __init__(self, radius: int, total: int):
        self.radius, self.total = radius, total
        self.chains = _chain_masks(radius)

    def linked(self, start: np.ndarray, x: np.ndarray, x2: np.ndarray) -> np.ndarray:
        """Positions of pairs that hold, of the differences x: chain by chain, then whole."""
        keep = np.arange(len(x))
        for size in range(3, self.radius + 1):  # two segments are settled by the key
            mask = np.array([c[size - 1] for c in self.chains], dtype=np.uint64)[start[keep]]
            keep = keep[np.bitwise_count(x[keep] & mask) <= size - 1]
        bits = np.bitwise_count(x[keep])
        hit = (bits <= self.radius) & (bits + np.bitwise_count(x2[keep]) <= self.total)
        return keep[hit]

    def near(self, fp, fp2, one, one2) -> np.ndarray:
        bits = np.bitwise_count(fp ^ one)
        return (bits <= self.radius) & (bits + np.bitwise_count(fp2 ^ one2) <= self.total)

    def large(self, fp, fp2, ids, n_index) -> tuple[np.ndarray, np.ndarray]:
        """Links that connect a large group, without laying out its pairs.

        Leaders take all within the radius; what is then connected already needs no more
        tests, so only members of different components are compared, in blocks.
        """
        comp, size = np.arange(len(fp)), np.ones(len(fp), dtype=np.int64)
        free = np.ones(n_index, dtype=bool)
        leaders, owner = [], np.full(n_index, -1)

        def join(rows: np.ndarray) -> None:
            labels = np.unique(comp[rows])
            low = labels[0]
            alone = labels[1:][size[labels[1:]] == 1]
            comp[alone] = low  # a row's first label is its own place
            for label in labels[1:][size[labels[1:]] > 1]:
                comp[comp == label] = low
            size[low] = size[labels].sum()

        for at in range(n_index):
            if not free[at]:
                continue
            near = np.flatnonzero(self.near(fp, fp2, fp[at], fp2[at]))
            taken = near[: np.searchsorted(near, n_index)]
            taken = taken[free[taken]]
            owner[taken] = len(leaders)
            free[taken] = False
            leaders.append(at)
            if len(near) > 1:
                join(near)
        for number, leader in enumerate(leaders):
            members = np.flatnonzero(owner == number)
            members = members[members != leader]
            if not len(members):
                continue
            others = np.flatnonzero(
                (comp != comp[leader]) & (np.bitwise_count(fp ^ fp[leader]) <= 2 * self.radius)
            )
            step = max(1, PAIRS // len(members))
            for cut in range(0, len(others), step):
                part = others[cut : cut + step]
                part = part[comp[part] != comp[leader]]
                hit = self.near(fp[part][:, None], fp2[part][:, None], fp[members][None], fp2[members][None]).any(axis=1)
                if hit.any():
                    join(np.append(part[hit], leader))
        first = np.full(len(fp), np.iinfo(np.int64).max)
        np.minimum.at(first, comp, ids)
        root = first[comp]
        moved = root != ids
        return ids[moved], root[moved]


def dealt_keys(prints: DataFrame, radius: int, block: int) -> DataFrame:
    """Rows (key, c1, c2, probe, id, fp, fp2): every fingerprint in the cells of its keys."""
    parts = segments(radius)
    n = len(parts)

    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fp = batch["fp"].to_numpy(dtype=np.int64).view(np.uint64)
            for i in range(n):
                (s, w), (s2, w2) = parts[i], parts[(i + 1) % n]
                first = (fp >> np.uint64(s)) & np.uint64((1 << w) - 1)
                second = (fp >> np.uint64(s2)) & np.uint64((1 << w2) - 1)
                base = (first << np.uint64(w2)) + np.uint64(i << 56)
                yield batch.assign(key=(base + second).view(np.int64), probe=False)
                for bit in range(w2):
                    clear = (second >> np.uint64(bit)) & np.uint64(1) == 0
                    key = base[clear] + (second[clear] | np.uint64(1 << bit))
                    yield batch[clear].assign(key=key.view(np.int64), probe=True)

    rows = prints.mapInPandas(keys, "id long, fp long, fp2 long, key long, probe boolean")
    load = rows.groupBy("key").agg(
        F.count_if(~F.col("probe")).alias("filed"), F.count_if(F.col("probe")).alias("looking")
    )
    hot = load.filter(f"filed > {block} OR looking > {block}").select(
        "key",
        F.ceil(F.col("filed") / block).cast("int").alias("cuts"),
        F.ceil(F.col("looking") / block).cast("int").alias("probe_cuts"),
    )
    rows = rows.join(hot, "key", "left").filter("cuts IS NULL OR cuts > 0")  # where none is filed, none is found
    # cell (c1, c2): blocks c1 <= c2 of the filed, or block c1 of the filed and cuts + c2 of those that look
    own = F.pmod(F.xxhash64("fp", "fp2"), F.when(F.col("probe"), F.col("probe_cuts")).otherwise(F.col("cuts"))).cast("int")
    turns = F.when(F.col("probe"), F.col("cuts")).otherwise(F.col("cuts") + F.col("probe_cuts"))
    rows = rows.withColumn("own", F.when(F.col("cuts").isNull(), F.lit(0)).otherwise(own)).withColumn(
        "other", F.explode(F.when(F.col("cuts").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), turns - 1)))
    )
    looks = F.col("probe") & F.col("cuts").isNotNull()
    return rows.select(
        "key",
        F.when(looks, F.col("other")).otherwise(F.least("own", "other")).alias("c1"),
        F.when(looks, F.col("cuts") + F.col("own")).otherwise(F.greatest("own", "other")).alias("c2"),
        "probe",
        "id",
        "fp",
        "fp2",
    )


def pigeonring_links(prints: DataFrame, radius: int, total: int = 128, block: int = BLOCK) -> DataFrame:
    """Links (a, b) whose components are those of all pairs within `radius` bits.

    Only pairs count that differ in at most `total` bits of both fingerprints together.

    prints: rows (id, fp, fp2) with distinct (fp, fp2). Fingerprints are cut into
    radius + 1 segments on a ring. Of two within the radius some chain of consecutive
    segments differs by at most l - 1 bits in its first l segments, for every l; so the
    first segment is equal and the second differs by one bit at most. Each fingerprint is
    filed under the key of every such pair of segments and looks in the keys that one
    more set bit gives. Inside a key the longer chains prune, then the whole distance
    decides. No pair is missed. Where a key has more than `block` filed or looking
    fingerprints, both kinds are cut into blocks; every filed block meets every other and
    every looking one in a cell of its own, so a task holds 2 blocks and no more.
    """
    rows = dealt_keys(prints, radius, block)

    def links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group = _Group(radius, total)
        for rows in whole_groups(batches, ["key", "c1", "c2"]):
            yield from compared(group, rows)

    def compared(group: _Group, rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        key = rows["key"].to_numpy()
        fp, fp2 = (rows[c].to_numpy(dtype=np.int64).view(np.uint64) for c in ("fp", "fp2"))
        ids, probe = rows["id"].to_numpy(dtype=np.int64), rows["probe"].to_numpy(dtype=bool)
        starts, ends = group_edges(rows, ["key", "c1", "c2"])
        filed_ = np.add.reduceat(~probe, starts, dtype=np.int64)
        size = ends - starts
        use = (filed_ > 0) & (size > 1)
        big = use & (filed_ * size > PAIRS // 4)
        left, right = [], []
        for a, b, f in zip(starts[big], ends[big], filed_[big]):
            x, y = group.large(fp[a:b], fp2[a:b], ids[a:b], f)
            left.append(x)
            right.append(y)
        use &= ~big
        row = np.repeat(np.cumsum(use) - 1, size)  # number of the group among those in use
        chosen = np.flatnonzero(np.repeat(use, size) & ~probe)
        count = ends[use][row[chosen]] - chosen - 1
        total = np.cumsum(count)
        at = 0
        while at < len(chosen):
            # a slice of index rows with a bounded number of pairs
            until = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PAIRS)))
            mine, n_mine = chosen[at:until], count[at:until]
            one = np.repeat(mine, n_mine)
            offset = np.arange(len(one)) - np.repeat(np.cumsum(n_mine) - n_mine, n_mine)
            two = one + 1 + offset
            hit = group.linked((key[one] >> 56).astype(np.int64), fp[one] ^ fp[two], fp2[one] ^ fp2[two])
            left.append(ids[one[hit]])
            right.append(ids[two[hit]])
            at = until
        if left:
            a, b = forest(np.concatenate(left), np.concatenate(right))
            if len(a):
                yield pd.DataFrame({"a": a, "b": b})

    dealt = rows.repartition("key", "c1", "c2").sortWithinPartitions("key", "c1", "c2", "probe")
    return dealt.mapInPandas(links, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 4,
    radius: int = 4,
    seeds: tuple[int, ...] = (42,),
) -> DataFrame:
    """One row per input row: id, fingerprint (16 hex digits), component_id.

    Texts are lower-cased in A-Z, words are runs without ASCII white space, shingles are
    `words` words joined by a space (a shorter text is one shingle; no words give
    fingerprint zero, which links like any other). Fingerprints link at `radius` or fewer
    differing bits; component_id is the smallest id reachable through links, the own one
    included. With two seeds there are 128 bits, and `radius` counts all of them: one of
    the two halves then differs in at most half the radius, and both halves are searched.
    A null text is empty. Rows that repeat a text share a component; rows that repeat an id
    with texts apart are told apart, each by its own fingerprint; a row with a null id has the component of its fingerprint, null if no row with an id shares it, and
    forms no links of its own. An empty table gives an empty result.
    """
    prints = settle(fingerprints(docs, id_col, text_col, words, seeds))
    distinct = settle(prints.groupBy("fp", "fp2").agg(F.min("doc_id").alias("id")))
    known = distinct.filter("id IS NOT NULL")
    if len(seeds) == 1:
        links = pigeonring_links(known, radius)
    else:
        turned = known.select("id", F.col("fp2").alias("fp"), F.col("fp").alias("fp2"))
        known = known.select("id", "fp", "fp2")
        links = pigeonring_links(known, radius // 2, radius).unionByName(pigeonring_links(turned, radius // 2, radius))
    found = components(links)
    classes = distinct.join(found, distinct["id"] == found["node"], "left").select(
        "fp", "fp2", F.coalesce("component_id", "id").alias("component_id")
    )
    return prints.join(classes, ["fp", "fp2"]).select(
        F.col("doc_id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, radius: int = 4) -> DataFrame:
    """The rows of docs without those in whose group a smaller id stays, columns as they are.

    Groups are the components of `near_duplicates`, whose rules hold here. Rows that repeat
    an id count as one document: they go together, and only where each of their
    fingerprints has a smaller id in its group. Rows with a null id pass. An empty table
    stays empty.
    """
    found = near_duplicates(docs.select(id_col, text_col), id_col, text_col, words, radius)
    mark = free_name(docs.columns, "gone")
    gone = (
        found.filter(F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias(mark))
        .agg(F.bool_and(F.col("component_id") < F.col(id_col)).alias("all"))
        .filter("all")
        .select(mark)
    )
    return docs.join(settle(gone), F.col(id_col).cast("long") == F.col(mark), "left_anti").select(docs.columns)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {"op2_simhash": op2_simhash}
