"""WARC archives on the shared folder, and a two-level capture index over them."""

from __future__ import annotations

import bisect
import math
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pandas as pd
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockwise.llm.common import table, whole_text
from dockwise.session import settle, work_dir

#: Payloads shorter than this are never revisits.
LEAST_PAYLOAD = 100
#: Compressed bytes after which a task begins another archive.
ARCHIVE_BYTES = 64 << 20
#: Captures in a compressed block of the index.
BLOCK_LINES = 256
#: Captures in a part of the index, and archive bytes that a task reads, on average at most.
PART_CAPTURES, TASK_BYTES = 500_000, 64 << 20
#: Stands for a null id in keys, below every id that occurs.
NO_ID = -(2**63)
#: The tables carry no capture time.
DATE = "1970-01-01T00:00:00Z"
#: Fixed value: the profile of a revisit with the same payload.
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def clean_uri(url: str | None) -> str:
    """A URL without characters that would break a header or an index line."""
    return quote(url or "", safe="!#$%&'()*+,/:;=?@[]~-._")


def surt(url: str | None) -> str:
    """Reversed-host key of a URL: `http://www.a.org/x?y` gives `org,a)/x?y`."""
    text = clean_uri(url)
    try:
        parts = urlsplit(text)
        host, port = (parts.hostname or ""), parts.port
    except ValueError:
        return ")" + text
    if not host:
        return ")" + text.partition("#")[0]
    host = re.sub(r"^www\d*\.", "", host)
    tail = f":{port}" if port and port not in (80, 443) else ""
    query = f"?{parts.query}" if parts.query else ""
    return ",".join(reversed(host.split("."))) + tail + ")" + (parts.path or "/") + query


def _place(root: str):
    """File system and path of a folder that every executor reaches."""
    return arrow_fs.FileSystem.from_uri(root if "://" in root or root.startswith("/") else root.replace(":", "://", 1))


def record(page_id, url, payload: bytes, digest: str, target_id=None, target_url=None) -> bytes:
    """One WARC record; a revisit holds the HTTP head only."""
    revisit = target_id is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {clean_uri(url)}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http;msgtype=response",
    ]
    if revisit:
        head += [
            f"WARC-Profile: {SAME_PAYLOAD}",
            f"WARC-Refers-To: <urn:page:{target_id}>",
            f"WARC-Refers-To-Target-URI: {clean_uri(target_url)}",
        ]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """Type, id, target, stated digest and payload of one record; the payload of a revisit is None."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode().split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.lower()] = value.strip()
    block = rest[: int(fields["content-length"])]
    _, _, payload = block.partition(b"\r\n\r\n")

    def page(name):
        found = fields.get(name, "")[len("<urn:page:") : -1]
        return int(found) if found else None

    kind = fields["warc-type"]
    return {
        "page_id": page("warc-record-id"),
        "record_type": kind,
        "refers_to": page("warc-refers-to"),
        "refers_to_key": surt(fields["warc-refers-to-target-uri"]) if kind == "revisit" else None,
        "stated_digest": fields["warc-payload-digest"].removeprefix("sha256:"),
        "payload": payload if kind == "response" else None,
    }


def _gzip(raw: bytes) -> bytes:
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


class _Files:
    """Numbered files of one task; a retried task writes files of other names."""

    def __init__(self, root: str, suffix: str):
        self.place, path = _place(root)
        self.place.create_dir(path, recursive=True)
        self.root, self.path, self.suffix, self.out, self.at = root, path, suffix, None, 0

    def add(self, raw: bytes, limit: int) -> tuple[str, int, int]:
        """Appends some bytes; returns the file's name, the offset and the length."""
        if self.out is None or self.at >= limit:
            self.close()
            self.name = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}{self.suffix}"
            self.out, self.at = self.place.open_output_stream(f"{self.path}/{self.name}", compression=None), 0
        self.out.write(raw)
        begin, self.at = self.at, self.at + len(raw)
        return self.name, begin, len(raw)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


CAPTURES = "page_id long, key string, file string, offset long, length long"


def write_archives(
    pages: DataFrame,
    root: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least: int = LEAST_PAYLOAD,
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Writes every row as a WARC record under root; returns the captures that were written.

    Records are gzip members of their own in archives of about archive_bytes. Of equal
    payloads of at least `least` bytes the one with the smallest id is a response, the
    others are revisits that refer to it; all smaller ones are responses. A null html is an
    empty payload; rows with a null id refer to others but are never referred to; rows that
    repeat the smallest id are all responses; an empty table writes nothing. Captures are
    rows (page_id, key, file, offset, length) and name only files of tasks that succeeded.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        whole_text(html_col).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    # written first: the join then knows how few payloads occur twice
    first = settle(
        rows.filter(F.octet_length("payload") >= least)
        .groupBy("digest")
        .agg(F.min("page_id").alias("target_id"), F.min_by("url", "page_id").alias("target_url"), F.count("*").alias("n"))
        .filter("n > 1 AND target_id IS NOT NULL")
        .drop("n")
    )
    refers = (F.octet_length("payload") >= least) & ~F.col("page_id").eqNullSafe(F.col("target_id"))
    rows = rows.join(first, "digest", "left").select(
        "page_id",
        "url",
        "payload",
        "digest",
        F.when(refers, F.col("target_id")).alias("target_id"),
        F.when(refers, F.col("target_url")).alias("target_url"),
    )

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files = _Files(root, ".warc.gz")
        for batch in batches:
            out = []
            for page_id, url, payload, digest, target, target_url in batch.itertuples(index=False):
                page_id = None if pd.isna(page_id) else int(page_id)
                target = None if pd.isna(target) else int(target)
                raw = record(page_id, url, bytes(payload), digest, target, target_url)
                out.append((page_id, surt(url), *files.add(_gzip(raw), archive_bytes)))
            yield pd.DataFrame(out, columns=["page_id", "key", "file", "offset", "length"]).astype({"page_id": "Int64"})
        files.close()

    return settle(rows.mapInPandas(write, CAPTURES))


def _tasks(df: DataFrame, wanted: float) -> int:
    """As many tasks as wanted, and as a shuffle of this session has at least: adaptive execution sees few bytes."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(wanted))


DIRECTORY = "part int, key string, id long, file string, offset long, length long"


def build_index(captures: DataFrame, root: str, lines: int = BLOCK_LINES) -> DataFrame:
    """Writes the sorted captures as compressed blocks under root; returns the block directory.

    Captures are sorted by reversed-host key and id over ranges, so a host with a third of
    all pages lies in many parts; their number follows the number of captures. Every `lines` captures become one compressed block; the
    directory holds part, first key and place of each block, a small fraction of the rows.
    """
    ranged = captures.withColumn("id", F.coalesce("page_id", F.lit(NO_ID))).drop("page_id")
    parts = _tasks(captures, captures.count() / PART_CAPTURES)
    ranged = ranged.repartitionByRange(parts, "key", "id").sortWithinPartitions("key", "id")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files = _Files(root, ".cdx.gz")
        part = TaskContext.get().partitionId()
        rest, out = [], []

        def block(rows):
            text = "\n".join(f"{r.key} {r.id} {r.file} {r.offset} {r.length}" for r in rows)
            out.append((part, rows[0].key, rows[0].id, *files.add(_gzip(text.encode()), 1 << 62)))

        for batch in batches:
            rest += list(batch.itertuples(index=False))
            while len(rest) >= lines:
                block(rest[:lines])
                rest = rest[lines:]
        if rest:
            block(rest)
        files.close()
        if out:
            yield pd.DataFrame(out, columns=["part", "key", "id", "file", "offset", "length"])

    return settle(ranged.mapInPandas(write, DIRECTORY))


def _read(place, path: str, offset: int, length: int) -> bytes:
    with place.open_input_file(path) as file:
        return zlib.decompress(file.read_at(int(length), int(offset)), 31)


def lookup(keys: DataFrame, directory: DataFrame, index_root: str) -> DataFrame:
    """All captures of some (key, id) rows; those without a capture are left out.

    The first key of every index part is known to all tasks (a row for each part of the
    index files, not for each capture), so keys are dealt to the part that can hold them.
    There a binary search in the block directory names the block to range-read (and those
    after it where captures that repeat a key and id run on), and a binary search in that
    block finds the capture. A part of the index is bounded by PART_CAPTURES.
    """
    firsts = sorted(
        (r["first"]["key"], r["first"]["id"], r["part"])
        for r in directory.groupBy("part").agg(F.min(F.struct("key", "id")).alias("first")).collect()
    )
    bounds, parts = [f[:2] for f in firsts], [f[2] for f in firsts]

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at = [bisect.bisect_right(bounds, k) - 1 for k in zip(batch["key"], batch["id"].tolist())]
            yield batch.assign(part=[parts[a] if a >= 0 else -1 for a in at]).astype({"part": "int32"})

    def search(wanted: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(wanted) and len(blocks):
            place, path = _place(index_root)
            blocks = blocks.sort_values(["key", "id"])
            starts = list(zip(blocks["key"], blocks["id"].tolist()))
            opened, lines = None, []
            for key in sorted(zip(wanted["key"], wanted["id"].tolist())):
                at = max(0, bisect.bisect_left(starts, key) - 1)
                while at < len(starts) and starts[at] <= key:
                    if at != opened:
                        row = blocks.iloc[at]
                        text = _read(place, f"{path}/{row['file']}", row["offset"], row["length"]).decode()
                        lines = [line.split(" ") for line in text.split("\n")]
                        opened = at
                    k = bisect.bisect_left(lines, key, key=lambda p: (p[0], int(p[1])))
                    while k < len(lines) and (lines[k][0], int(lines[k][1])) == key:
                        out.append((key[1], key[0], lines[k][2], int(lines[k][3]), int(lines[k][4])))
                        k += 1
                    at += 1
        return pd.DataFrame(out, columns=["page_id", "key", "file", "offset", "length"])

    wanted = keys.select("key", "id").distinct().mapInPandas(deal, "key string, id long, part int")
    return wanted.groupBy("part").cogroup(directory.groupBy("part")).applyInPandas(search, CAPTURES)


RECORDS = (
    "page_id long, record_type string, refers_to long, refers_to_key string, stated_digest string, payload binary"
)


def _frame(found: list[dict]) -> pd.DataFrame:
    frame = pd.DataFrame(found, columns=["page_id", "record_type", "refers_to", "refers_to_key", "stated_digest", "payload"])
    return frame.astype({"page_id": "Int64", "refers_to": "Int64"})


def scan_archives(captures: DataFrame, root: str) -> DataFrame:
    """All records of the archives that captures name, read member by member from their start."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place, path = _place(root)
        for batch in batches:
            for name in batch["file"]:
                found, size = [], 0
                with place.open_input_stream(f"{path}/{name}", compression=None) as file:
                    unpack, raw, rest = zlib.decompressobj(31), [], b""
                    while True:
                        rest = rest or file.read(1 << 20)
                        if not rest:
                            break
                        raw.append(unpack.decompress(rest))
                        rest = unpack.unused_data
                        if unpack.eof:
                            found.append(parse(b"".join(raw)))
                            size += sum(map(len, raw))
                            unpack, raw = zlib.decompressobj(31), []
                            if size > 8 << 20:
                                yield _frame(found)
                                found, size = [], 0
                if found:
                    yield _frame(found)

    archives = settle(captures.groupBy("file").agg(F.max(F.col("offset") + F.col("length")).alias("bytes")))
    sizes = archives.agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes")).first()
    dealt = archives.select("file").repartition(min(max(1, sizes["n"]), _tasks(captures, (sizes["bytes"] or 0) / TASK_BYTES)), "file")
    return dealt.mapInPandas(scan, RECORDS)


def fetch(captures: DataFrame, root: str) -> DataFrame:
    """The records at the places that captures name, by range reads."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place, path = _place(root)
        for batch in batches:
            for at in range(0, len(batch), 64):
                part = batch.iloc[at : at + 64]
                raws = (
                    _read(place, f"{path}/{f}", o, n) for f, o, n in zip(part["file"], part["offset"], part["length"])
                )
                yield _frame([parse(raw) for raw in raws])

    captures = settle(captures.select("file", "offset", "length"))
    tasks = _tasks(captures, (captures.agg(F.sum("length")).first()[0] or 0) / TASK_BYTES)
    dealt = captures.repartition(tasks, "file", F.floor(F.col("offset") / (4 << 20)))
    return dealt.sortWithinPartitions("file", "offset").mapInPandas(read, RECORDS)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, index_root = work_dir(spark, "warc"), work_dir(spark, "cdx")
    captures = write_archives(table(spark, sf_dir, "pages"), root)
    directory = build_index(captures, index_root)
    digests = [F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest")]
    read = settle(
        scan_archives(captures, root).select("page_id", "record_type", "refers_to", "refers_to_key", "stated_digest", *digests)
    )
    revisits = read.filter("record_type = 'revisit'").drop("payload_bytes", "payload_digest")
    wanted = revisits.select(F.col("refers_to_key").alias("key"), F.col("refers_to").alias("id")).distinct()
    targets = fetch(lookup(wanted, directory, index_root), root).filter("record_type = 'response'")
    targets = settle(targets.select(F.col("page_id").alias("refers_to"), *digests).distinct())
    # an id that repeats may stand for several payloads; the digest in the revisit tells which one is meant
    full = revisits.withColumnRenamed("stated_digest", "payload_digest").join(targets, ["refers_to", "payload_digest"])
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return read.filter("record_type = 'response'").select(columns).unionByName(full.select(columns))


SQL = {
    "op3_warc": """
        WITH t AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
            FROM pages),
        f AS (
            SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM t)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
        FROM f
    """
}
QUERIES = {"op3_warc": op3_warc}
