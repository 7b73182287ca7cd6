"""A Merkle manifest of a dataset: roots, witnesses that grow as rows are appended, and their check."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dockwise.llm.common import table
from dockwise.session import settle

#: Consecutive nodes that become one node of the next level.
ARITY = 3
#: Levels of a block: a task appends ARITY ** HEIGHT nodes at most, then hands on their root.
HEIGHT = 6
#: What a leaf covers, in this order.
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def digest(parts: list[str]) -> str:
    """Lower-case hex SHA-256 of digests as hex text, one after the other."""
    return hashlib.sha256("".join(parts).encode()).hexdigest()


class Appender:
    """A tree that grows by appending, and the witnesses of everything appended so far.

    Complete runs of `arity` nodes close at once; what is still open waits at its level with
    the span of leaves it covers. When a run closes, the witness of every leaf under each of
    its nodes is extended by that node's place and its siblings, so a leaf's witness is
    partial until the last sibling above it is there.
    """

    def __init__(self, arity: int = ARITY):
        self.arity, self.open, self.witness = arity, [[]], []

    def append(self, leaf: str) -> None:
        self.witness.append([])
        self._put(0, (leaf, len(self.witness) - 1, len(self.witness)))

    def _put(self, level: int, node: tuple[str, int, int]) -> None:
        while True:
            if level == len(self.open):
                self.open.append([])
            self.open[level].append(node)
            if len(self.open[level]) < self.arity:
                return
            node, level = self._complete(level), level + 1

    def _complete(self, level: int) -> tuple[str, int, int]:
        run, self.open[level] = self.open[level], []
        found = [d for d, _, _ in run]
        for place, (_, first, end) in enumerate(run):
            step = f"{place}:{''.join(found[:place] + found[place + 1:])}"
            for leaf in range(first, end):
                self.witness[leaf].append(step)
        return digest(found), run[0][1], run[-1][2]

    def close(self, height: int | None) -> str:
        """Completes the open runs and returns the root, `height` levels up or where one node is left."""
        level = 0
        while True:
            if level == len(self.open):
                self.open.append([])
            run = self.open[level]
            done = level == height if height is not None else len(run) == 1 and not any(self.open[level + 1 :])
            if done:
                return run[0][0]
            if run:
                self._put(level + 1, self._complete(level))
            level += 1


def grown(leaves: list[str], block: int, arity: int, height: int) -> tuple[str, list[list[str]]]:
    """Root and witnesses of the nodes of one block; the tree's only block ends at its root."""
    tree = Appender(arity)
    for leaf in leaves:
        tree.append(leaf)
    # only a block that is first and not full can be the whole tree before its last level
    return tree.close(height if block or len(leaves) == arity**height else None), tree.witness


def fold(leaf: str, witness: str) -> str:
    """The root that a leaf and a witness give."""
    for step in witness.split("/") if witness else []:
        place, _, siblings = step.partition(":")
        run = [siblings[k : k + 64] for k in range(0, len(siblings), 64)]
        run.insert(int(place), leaf)
        leaf = digest(run)
    return leaf


def encoded(value: Column) -> Column:
    """`-` for null, else the UTF-8 bytes of a value after their number and a colon."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(values: list[Column]) -> Column:
    """The digest of a row as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*[encoded(v) for v in values]).cast("binary"), 256))


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """rows (tree, ...) with `rank`, from 0 in the order of the given columns inside each tree.

    Rows are range-partitioned by tree and order, so a tree with a third of all rows lies in
    many parts. A part's rows are numbered where they are sorted; one row for each tree and
    part tells how many rows of the tree lie before it.
    """
    by = ["tree", *order, "read_at"]  # where all else is equal, rows stay in the order they are read in
    ranged = rows.withColumn("read_at", F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by)
    ranged = settle(ranged.withColumn("at", F.monotonically_increasing_id()).drop("read_at"))  # written: numbers stay
    part = F.shiftright("at", 33)
    parts = ranged.groupBy("tree", part.alias("part")).agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("tree", "part", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"))
    joined = ranged.withColumn("part", part).join(parts, ["tree", "part"])
    return joined.withColumn("rank", F.col("at") + F.col("shift")).drop("at", "shift", "part")


def _blocks(nodes: DataFrame, arity: int, height: int, kept: list[str]) -> DataFrame:
    """Aligned blocks of nodes (tree, rank, node): at most arity ** height in a row, in order."""
    entry = F.struct("rank", F.lower(F.hex("node")).alias("node"), *kept)
    block = F.expr(f"rank div {arity**height}").alias("block")
    return settle(nodes.groupBy("tree", block).agg(F.sort_array(F.collect_list(entry)).alias("entries")))


def _rounds(nodes: DataFrame, arity: int, height: int, kept: list[str]) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of every round, and rows (tree, node): the roots. Block roots are appended in the round after."""

    def roots(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [
                grown([e["node"] for e in entries], block, arity, height)[0]
                for entries, block in zip(batch["entries"], batch["block"])
            ]
            yield pd.DataFrame({"tree": batch["tree"], "rank": batch["block"], "node": [bytes.fromhex(f) for f in found]})

    rounds = []
    while True:
        rounds.append(_blocks(nodes, arity, height, [] if rounds else kept))
        slim = rounds[-1].withColumn("entries", F.transform("entries", lambda e: F.struct(e["node"].alias("node"))))
        nodes = slim.mapInPandas(roots, "tree string, rank long, node binary")
        if not rounds[-1].agg(F.max("block")).first()[0]:
            return rounds, settle(nodes.select("tree", "node"))


def _lowered(blocks: DataFrame, above: DataFrame, arity: int, height: int, kept: list[str]) -> DataFrame:
    """Witnesses of a round's nodes: those inside their block, then that of the block, of above(tree, rank, witness, ...)."""
    more = [c for c in above.columns if c not in ("tree", "rank", "witness")]
    element = blocks.schema["entries"].dataType.elementType
    types = {f.name: f.dataType.simpleString() for f in [*element.fields, *above.schema.fields]}

    def lower(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.to_dict("records"):
                entries = row["entries"]
                _, witness = grown([e["node"] for e in entries], row["block"], arity, height)
                upper = [row["witness"]] if row["witness"] else []
                columns = {k: [e[k] for e in entries] for k in ["rank", *kept]}
                columns["witness"] = ["/".join(w + upper) for w in witness]
                columns |= {k: [row[k]] * len(entries) for k in ["tree", *more]}
                for k in kept:
                    if types[k] == "bigint":
                        columns[k] = pd.array(columns[k], dtype="Int64")
                yield pd.DataFrame(columns)

    joined = blocks.join(above.withColumnRenamed("rank", "block"), ["tree", "block"])
    names = ["tree", "rank", "witness", *kept, *more]
    schema = ", ".join(f"{n} {'bigint' if n == 'rank' else types[n]}" for n in names)
    return joined.mapInPandas(lower, schema)


def manifest(
    docs: DataFrame,
    shown: Column | None = None,
    fields: list[str] | None = None,
    id_col: str = "doc_id",
    group_col: str = "source",
    arity: int = ARITY,
    height: int = HEIGHT,
) -> DataFrame:
    """One row per input row: id, leaf, shown, subroot, root, witness; digests are lower-case hex.

    A leaf covers the given fields of a row. Inside a group leaves ascend by id; every
    `arity` consecutive nodes become one (the last run fewer) while several are left, which
    gives the group's subroot; the subroots, ordered by the group's UTF-8 bytes, give the
    root in the same way. A witness holds one step for each level up to the root, parted by
    `/`: the place in the run, a colon, and the siblings from left to right; `fold` follows it.
    `shown` is a column with the digest (32 bytes) that a reader presents for a row, null for its leaf.

    Leaves are ranked over ranges. Aligned blocks of arity ** height of them are appended to a
    tree of their own, which gives each leaf the lower part of its witness; the block's root
    is appended to the tree of block roots, and so on, and each later completion extends the
    witnesses below. A task holds one block, whatever the size of a group.

    Null groups are one group, the first; null ids come first in it; rows that repeat an id
    are ordered by their leaf, and equal rows are leaves of their own with one proof for
    each. A null field counts as `-`. An empty table gives an empty result; columns that are
    not among the fields are not read.
    """
    leaf = leaf_of([F.col(c) for c in fields or FIELDS])
    group = F.col(group_col).cast("string")
    leaves = docs.select(
        F.when(group.isNull(), "").otherwise(F.concat(F.lit(":"), group)).alias("tree"),
        F.col(id_col).cast("long").alias("id"),
        leaf.alias("node"),
        F.lower(F.hex(F.lit(None).cast("binary") if shown is None else shown)).alias("shown"),
    )
    rounds, subroots = _rounds(ranked(leaves, ["id", "node"]), arity, height, ["id", "shown"])
    tops = ranked(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "node"), ["name"])
    top_rounds, root = _rounds(tops, arity, height, ["name"])
    above = root.select("tree", F.lit(0).cast("long").alias("rank"), F.lit("").alias("witness"), F.lower(F.hex("node")).alias("root"))
    for number, blocks in reversed(list(enumerate(top_rounds))):
        above = settle(_lowered(blocks, above, arity, height, [] if number else ["name"]))
    hexed = F.lower(F.hex("node")).alias("subroot")
    above = above.select(F.col("name").alias("tree"), F.lit(0).cast("long").alias("rank"), "witness", "root")
    above = above.join(subroots.select("tree", hexed), "tree")
    for number, blocks in reversed(list(enumerate(rounds))):
        above = _lowered(blocks, above, arity, height, [] if number else ["id", "node", "shown"])
        if number:
            above = settle(above)
    return above.select(
        F.col("id").alias(id_col), F.col("node").alias("leaf"), F.coalesce("shown", "node").alias("shown"),
        "subroot", "root", "witness",
    )


def verified(rows: DataFrame) -> DataFrame:
    """Rows of `manifest` with folded_root, from what is shown and the witness, and whether it is the root."""

    @F.pandas_udf("string")
    def folded(leaves: pd.Series, witnesses: pd.Series) -> pd.Series:
        return pd.Series([fold(leaf, w) for leaf, w in zip(leaves, witnesses)], dtype=object)

    rows = rows.withColumn("folded_root", folded("shown", "witness"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def tampered(fields: list[str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The leaf of a row whose text lost its line feeds, where the id's CRC-32 is even; else null."""
    changed = [F.replace(F.col(c), F.lit("\n"), F.lit("")) if c == text_col else F.col(c) for c in fields or FIELDS]
    even = F.crc32(F.col(id_col).cast("string").cast("binary")) % 2 == 0
    return F.when(even & F.contains(F.col(text_col), F.lit("\n")), leaf_of(changed))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = verified(manifest(table(spark, sf_dir, "documents"), tampered()))
    siblings = F.regexp_replace("witness", "(^|/)[0-9]+:", "")
    return found.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(siblings.cast("binary"), 256).alias("proof_sha256"), "folded_root", "verified"
    )


SQL = {
    "op11_merkle": r"""
        WITH RECURSIVE enc AS (
            SELECT doc_id, source, text,
                   coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '-')
                   || coalesce(strlen(source) || ':' || source, '-')
                   || coalesce(strlen(lang) || ':' || lang, '-')
                   || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars::VARCHAR, '-') AS head
            FROM documents),
        bits AS (
            SELECT n, (SELECT list_reduce(list_prepend(n, range(8)), lambda c, k:
                       CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS v
            FROM (SELECT unnest(range(256)) AS n)),
        lookup AS (SELECT list(v ORDER BY n) AS crcs FROM bits),
        leaves AS (
            SELECT doc_id, source,
                   sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                   CASE WHEN xor(list_reduce(
                            list_prepend(4294967295::BIGINT, [ascii(x)::BIGINT FOR x IN string_split(doc_id::VARCHAR, '')]),
                            lambda c, x: xor(c >> 8, crcs[(xor(c, x) & 255) + 1])), 4294967295) % 2 = 0
                   THEN sha256(head || coalesce(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-'))
                   ELSE sha256(head || coalesce(strlen(text) || ':' || text, '-')) END AS shown
            FROM enc, lookup),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS idx, count(*) OVER (PARTITION BY source) AS n
            FROM leaves),
        low(source, level, idx, n, node) AS (
            SELECT source, 0, idx, n, leaf FROM placed
            UNION ALL
            SELECT source, max(level) + 1, idx // 3, (max(n) + 2) // 3, sha256(string_agg(node, '' ORDER BY idx))
            FROM low WHERE n > 1 GROUP BY source, idx // 3),
        subs AS (
            SELECT source, node, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS idx, count(*) OVER () AS n
            FROM low WHERE n = 1),
        high(level, idx, n, node) AS (
            SELECT 0, idx, n, node FROM subs
            UNION ALL
            SELECT max(level) + 1, idx // 3, (max(n) + 2) // 3, sha256(string_agg(node, '' ORDER BY idx))
            FROM high WHERE n > 1 GROUP BY idx // 3),
        runs AS (
            SELECT source, level, idx // 3 AS run, list(node ORDER BY idx) AS nodes FROM low WHERE n > 1 GROUP BY ALL),
        high_runs AS (SELECT level, idx // 3 AS run, list(node ORDER BY idx) AS nodes FROM high WHERE n > 1 GROUP BY ALL),
        walk(doc_id, source, level, idx, node, proof) AS (
            SELECT doc_id, source, 0, idx, shown, '' FROM placed
            UNION ALL
            SELECT w.doc_id, w.source, w.level + 1, w.idx // 3,
                   sha256(list_aggregate([CASE WHEN k = w.idx % 3 + 1 THEN w.node ELSE r.nodes[k] END
                                          FOR k IN range(1, len(r.nodes) + 1)], 'string_agg', '')),
                   w.proof || coalesce(list_aggregate([r.nodes[k] FOR k IN range(1, len(r.nodes) + 1)
                                                       IF k <> w.idx % 3 + 1], 'string_agg', ''), '')
            FROM walk w JOIN runs r
              ON r.source IS NOT DISTINCT FROM w.source AND r.level = w.level AND r.run = w.idx // 3),
        lows AS (SELECT * FROM walk QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY level DESC) = 1),
        walk_high(doc_id, level, idx, node, proof) AS (
            SELECT l.doc_id, 0, s.idx, l.node, l.proof FROM lows l JOIN subs s ON s.source IS NOT DISTINCT FROM l.source
            UNION ALL
            SELECT w.doc_id, w.level + 1, w.idx // 3,
                   sha256(list_aggregate([CASE WHEN k = w.idx % 3 + 1 THEN w.node ELSE r.nodes[k] END
                                          FOR k IN range(1, len(r.nodes) + 1)], 'string_agg', '')),
                   w.proof || coalesce(list_aggregate([r.nodes[k] FOR k IN range(1, len(r.nodes) + 1)
                                                       IF k <> w.idx % 3 + 1], 'string_agg', ''), '')
            FROM walk_high w JOIN high_runs r ON r.level = w.level AND r.run = w.idx // 3),
        tops AS (SELECT * FROM walk_high QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY level DESC) = 1)
        SELECT p.doc_id, p.leaf, s.node AS subroot, h.node AS root, sha256(t.proof) AS proof_sha256,
               t.node AS folded_root, t.node = h.node AS verified
        FROM placed p
        JOIN subs s ON s.source IS NOT DISTINCT FROM p.source
        JOIN tops t ON t.doc_id = p.doc_id
        JOIN high h ON h.n = 1
    """
}
QUERIES = {"op11_merkle": op11_merkle}
