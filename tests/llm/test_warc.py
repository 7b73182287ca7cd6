"""WARC records, archives and the capture index."""

import gzip
import hashlib

import pytest
from pyarrow import fs
from pyspark.sql import functions as F

from dockwise.llm import warc
from dockwise.session import settle, work_dir


@pytest.mark.parametrize(
    "url, key",
    [
        ("http://www.a.org/x?y=1#z", "org,a)/x?y=1"),
        ("https://blog.B.example.com:8080/", "com,example,b,blog:8080)/"),
        ("https://b.org:443", "org,b)/"),
        ("not a url", ")not%20a%20url"),
        (None, ")"),
        ("http://[broken", ")http://[broken"),
        ("http://h.org/a b\r\nX: y", "org,h)/a%20b%0D%0AX:%20y"),
    ],
)
def test_surt(url, key):
    assert warc.surt(url) == key


def test_record_round_trip():
    payload = "WARC/1.1\r\n\r\nété\r\n\r\n".encode() * 3
    raw = warc.record(7, "http://a.org/\r\nX: 1", payload, "d")
    assert warc.parse(raw)["payload"] == payload and warc.parse(raw)["page_id"] == 7
    again = warc.parse(warc.record(9, "u", payload, "d", 7, "http://www.a.org/"))
    assert again == {
        "page_id": 9, "record_type": "revisit", "refers_to": 7, "refers_to_key": "org,a)/", "stated_digest": "d", "payload": None
    }
    assert warc.parse(warc.record(None, None, b"", "d"))["page_id"] is None


PAGES = [
    (5, "http://www.a.org/x", "p" * 100),
    (2, "http://a.org/y", "p" * 100),
    (9, "http://b.org/", "p" * 100),
    (3, "http://c.org/", "short"),
    (4, "http://c.org/", "short"),
    (6, None, None),
    (7, "http://d.org/", ""),
    (8, "http://d.org/", "é" * 50),
    (10, "http://d.org/", "é" * 50),
    (11, "http://e.org/", "x\r\n\r\nWARC/1.1\r\n" * 4000),
    (2, "http://a.org/y", "p" * 100),
    (None, "http://z.org/", "p" * 100),
]


@pytest.fixture(scope="module")
def archived(spark):
    root, index_root = work_dir(spark, "warc"), work_dir(spark, "cdx")
    df = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, digest string")
    captures = warc.write_archives(df.repartition(3), root, archive_bytes=300)
    return root, index_root, captures, warc.build_index(captures, index_root, lines=3)


def test_archives(spark, archived):
    root, _, captures, _ = archived
    got = sorted(
        (r["page_id"] or 0, r["record_type"], r["refers_to"], bytes(r["payload"] or b"").decode())
        for r in warc.scan_archives(captures, root).collect()
    )
    want = sorted(
        (i or 0, *(("revisit", 2, "") if i in (5, 9, None) else ("revisit", 8, "") if i == 10 else ("response", None, h or "")))
        for i, _, h in PAGES
    )
    assert got == want
    # every record is a gzip member of its own, at the place the capture names
    place, path = warc._place(root)
    for r in captures.collect():
        with place.open_input_file(f"{path}/{r['file']}") as file:
            assert gzip.decompress(file.read_at(r["length"], r["offset"])).startswith(b"WARC/1.1\r\nWARC-Type: ")
    assert captures.select("file").distinct().count() > 3  # archives are closed at their size


def test_lookup_and_fetch(spark, archived):
    root, index_root, captures, directory = archived
    assert directory.count() < captures.count() == len(PAGES)
    keys = [(warc.surt(u), warc.NO_ID if i is None else i) for i, u, _ in PAGES] + [("aaa", 1), ("zzz", 1), ("org,a)/y", 3)]
    found = warc.lookup(spark.createDataFrame(keys, "key string, id long"), directory, index_root)
    assert {(r["key"], r["page_id"]) for r in found.collect()} == set(keys[: len(PAGES)])
    assert found.count() == len(PAGES)  # the page that stands there twice is one key with two captures
    read = warc.fetch(found.filter("page_id = 11"), root).collect()
    assert bytes(read[0]["payload"]).decode() == PAGES[9][2]


def test_files_that_no_committed_task_names_are_not_read(spark, archived):
    root, _, captures, _ = archived
    place, path = warc._place(root)
    with place.open_output_stream(f"{path}/orphan.warc.gz", compression=None) as out:
        out.write(b"broken")
    assert warc.scan_archives(captures, root).count() == len(PAGES)
    assert any(f.base_name == "orphan.warc.gz" for f in place.get_file_info(fs.FileSelector(path)))


def test_captures_that_repeat_a_key_run_through_blocks(spark):
    root, index_root = work_dir(spark, "warc"), work_dir(spark, "cdx")
    pages = [(1, "http://a.org/", f"{k}") for k in range(20)] + [(0, "http://a.org/", "x"), (2, "http://a.org/", "y")]
    captures = warc.write_archives(spark.createDataFrame(pages, "page_id long, url string, html string"), root)
    directory = warc.build_index(captures, index_root, lines=3)
    found = warc.lookup(spark.createDataFrame([("org,a)/", 1)], "key string, id long"), directory, index_root)
    assert {bytes(r["payload"]).decode() for r in warc.fetch(found, root).collect()} == {f"{k}" for k in range(20)}
    assert found.count() == 20


def test_archives_are_read_by_many_tasks(spark):
    root = work_dir(spark, "warc")
    pages = [(k, f"http://a.org/{k}", f"{k} " * 200) for k in range(64)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(4)
    captures = warc.write_archives(df, root, archive_bytes=500)
    assert captures.select("file").distinct().count() >= 16
    read = settle(warc.scan_archives(captures, root).withColumn("task", F.spark_partition_id()))
    assert read.count() == 64 and read.select("task").distinct().count() > 2
    parts = settle(warc.fetch(captures, root).withColumn("task", F.spark_partition_id()))
    assert parts.count() == 64 and parts.select("task").distinct().count() > 2


def test_ids_that_repeat_with_other_payloads(spark, tmp_path):
    a, b, c = "A" * 150, "B" * 150, "C" * 150
    pages = [(1, "http://a.org/", a), (1, "http://a.org/", b), (2, "http://b.org/", a), (3, "http://c.org/", b)]
    pages += [(1, "http://a.org/", a), (4, "http://d.org/", c), (5, "http://a.org/", c), (5, "http://a.org/", a)]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = [tuple(r) for r in warc.op3_warc(spark, str(tmp_path)).collect()]
    sha = {x: hashlib.sha256(x.encode()).hexdigest() for x in (a, b, c)}
    want = [(1, 150, sha[a], "response", None)] * 2 + [(1, 150, sha[b], "response", None), (4, 150, sha[c], "response", None)]
    want += [(2, 150, sha[a], "revisit", 1), (3, 150, sha[b], "revisit", 1), (5, 150, sha[c], "revisit", 4), (5, 150, sha[a], "revisit", 1)]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_empty(spark):
    root, index_root = work_dir(spark, "warc"), work_dir(spark, "cdx")
    none = spark.createDataFrame([], "page_id long, url string, html string")
    captures = warc.write_archives(none, root)
    directory = warc.build_index(captures, index_root)
    keys = spark.createDataFrame([("a", 1)], "key string, id long")
    assert captures.count() == directory.count() == warc.lookup(keys, directory, index_root).count() == 0
    assert warc.scan_archives(captures, root).count() == 0


def test_query(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    first = {}
    for p in pages:
        h = p["html"] or ""
        first[h] = min(first.get(h, p["page_id"]), p["page_id"])
    want = set()
    for p in pages:
        raw = (p["html"] or "").encode()
        target = first[p["html"] or ""] if len(raw) >= 100 else p["page_id"]
        kind = "response" if target == p["page_id"] else "revisit"
        want.add((p["page_id"], len(raw), hashlib.sha256(raw).hexdigest(), kind, target if kind == "revisit" else None))
    got = warc.op3_warc(spark, sf_dir)
    assert {tuple(r) for r in got.collect()} == want
    assert got.agg(F.count("*")).first()[0] == len(pages)
