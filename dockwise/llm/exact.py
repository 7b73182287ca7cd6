"""Exact dedup over an extendible-hash index on shared files, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockwise.llm.common import WHITE, free_name, table, whole_text
from dockwise.session import settle

#: Distinct hashes that a bucket holds before it is split.
CAPACITY = 100_000
#: Bits of the hash that the directory may use; it has at most 2**MAX_DEPTH entries.
MAX_DEPTH = 16


def _slot(depth: int):
    """The leading bits of the 64-bit hash, as a number."""
    return F.shiftrightunsigned("h", 64 - depth)


def directory(entries: DataFrame, capacity: int = CAPACITY, max_depth: int = MAX_DEPTH) -> DataFrame:
    """The directory of an extendible-hash index: rows (slot, bucket, local_depth).

    There is one row per slot of max_depth leading bits that occurs. All buckets begin as
    one; while a bucket holds more than `capacity` distinct hashes and has bits left, the
    directory doubles and the bucket is split by its next bit. Buckets that are not
    overfull keep their local depth, and several slots lead to them. A bucket of the
    largest depth is not split further: its collisions are chained. The table is bounded
    by 2**max_depth rows whatever the input.
    """
    slots = entries.select("h").distinct().groupBy(_slot(max_depth).alias("slot")).agg(F.count("*").alias("keys"))
    slots = settle(slots.withColumn("local_depth", F.lit(0)).withColumn("bucket", F.lit(0).cast("long")))
    for depth in range(max_depth):
        full = slots.groupBy("local_depth", "bucket").agg(F.sum("keys").alias("load")).filter(F.col("load") > capacity)
        if full.isEmpty():
            break
        split = F.col("load").isNotNull()
        slots = settle(
            slots.join(full, ["local_depth", "bucket"], "left").select(
                "slot",
                "keys",
                F.when(split, depth + 1).otherwise(F.col("local_depth")).alias("local_depth"),
                F.when(split, F.shiftrightunsigned("slot", max_depth - depth - 1)).otherwise(F.col("bucket")).alias("bucket"),
            )
        )
    return slots.select("slot", "bucket", "local_depth")


def _norm(text_col: str):
    return F.regexp_replace(whole_text(text_col), WHITE + "+", "")


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, max_depth: int = MAX_DEPTH
) -> DataFrame:
    """Groups of texts that are identical once all ASCII white space is deleted.

    Returns one row per input row: id, keep_id, group_size, kept, text_sha256, bucket. Of
    equal texts the one with the most code points in the original stays, then the smallest
    id. A null text is empty; an empty table gives an empty result; other columns are not
    read. Rows that repeat an id with the same text stand or fall together and all count in
    group_size. A null id ranks behind all ids, keep_id is null where only such rows share
    a text, and kept is then true. Ids are integers of 64 bits.

    How: each row's 64-bit hash goes to an entry file on the shared folder. The directory
    doubles until no bucket is overfull. Then the texts are grouped under (bucket, hash)
    by their bytes, so rows that merely collide on the hash are chained as separate
    entries and told apart by comparing the texts themselves. Tasks combine their copies
    before the shuffle, so a text that makes up a third of the table travels once per task.
    The resulting pages are written in key ranges; all entries then look up their page.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.length(whole_text(text_col)).alias("size"), _norm(text_col).alias("norm")
    ).withColumn("h", F.xxhash64("norm"))
    entries = settle(rows.select("doc_id", "h", F.unhex(F.sha2(F.col("norm").cast("binary"), 256)).alias("sha")))
    buckets = directory(entries, capacity, max_depth)

    # size first, then the smallest id, as one number that a hash aggregate can hold
    rank = F.expr("CAST(size AS DECIMAL(17, 0)) * 100000000000000000000 + coalesce(20000000000000000000 - doc_id, 0)")
    # at most 2**max_depth rows of three numbers: the bound that allows the broadcast
    placed = rows.withColumn("slot", _slot(max_depth)).join(F.broadcast(buckets), "slot")
    pages = (
        placed.select("bucket", "h", "norm", "size", rank.cast("decimal(38,0)").alias("rank"))
        .groupBy("bucket", "h", "norm")
        .agg(F.max("rank").alias("rank"), F.count("*").alias("group_size"))
    )
    keep = F.expr("CAST(nullif(20000000000000000000 - rank % 100000000000000000000, 20000000000000000000) AS BIGINT)")
    index = settle(
        pages.select(
            "bucket", "h", F.unhex(F.sha2(F.col("norm").cast("binary"), 256)).alias("sha"), keep.alias("keep_id"), "group_size"
        )
        .repartitionByRange("bucket", "h")
        .sortWithinPartitions("bucket", "h")
    )
    found = entries.join(index, ["h", "sha"])
    return found.select(
        F.col("doc_id").alias(id_col),
        "keep_id",
        F.col("group_size").cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
        "bucket",
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that `exact_dedup` keeps, one for each text; columns stay as they are.

    Of rows that repeat both id and text one is left; null ids are handled like any other.
    The texts are shuffled once by id and hash to meet the rows that go, at every size
    alike, and repeated rows fall together in the same shuffle.
    """
    found = exact_dedup(docs, id_col, text_col).filter("NOT kept")
    mark = free_name(docs.columns, "row_mark")
    gone = settle(found.select(_row_mark(F.col(id_col), F.col("text_sha256")).alias(mark)).distinct())
    sha = F.sha2(_norm(text_col).cast("binary"), 256)
    marked = docs.withColumn(mark, _row_mark(F.col(id_col), sha))
    left = marked.join(gone.hint("merge"), mark, "left_anti")
    return left.dropDuplicates([mark]).select(docs.columns)


def _row_mark(row_id, sha):
    """Id and hash of a row as one text, which a null id has as well."""
    return F.concat(F.coalesce(row_id.cast("long").cast("string"), F.lit("none")), F.lit(":"), sha)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents")).drop("bucket")


SQL = {
    "op4_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id, length(coalesce(text, '')) AS size,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm
            FROM documents)
        SELECT doc_id,
               first_value(doc_id) OVER w AS keep_id,
               count(*) OVER (PARTITION BY norm) AS group_size,
               doc_id = first_value(doc_id) OVER w AS kept,
               sha256(norm) AS text_sha256
        FROM t
        WINDOW w AS (PARTITION BY norm ORDER BY size DESC, doc_id
                     ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
    """
}
QUERIES = {"op4_exact_dedup": op4_exact_dedup}
