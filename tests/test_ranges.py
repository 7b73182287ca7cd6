"""Sources by byte range and by archive, against whole documents read at once."""

import csv
import io
import json
import random
import zipfile

import pytest
from conftest import rows
from pyspark.sql import functions as F

from dockwise.sources import files
from dockwise.sources import ranges as r


def document(rng, n, indent=None, head=True, tail=True):
    """A collection with texts full of brackets, quotes and backslashes, nested features and foreign members."""
    nasty = ["a\"b", "\\", "\\\\\"", '{"type":"Feature"}', "]}", "[{", '"features": [', "é ", "", "x" * 40, "\\u007b"]

    def feature(k):
        text = "".join(rng.choice(nasty) for _ in range(rng.randint(0, 6)))
        inner = {"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"id": "no"}, "geometry": None}]}
        properties = {"id": str(k), "text": text, "more": inner if rng.random() < 0.3 else [1, [2, {"features": [{}]}]]}
        point = {"type": "Point", "coordinates": [k, -k / 2]} if rng.random() < 0.8 else None
        made = {"properties": properties, "geometry": point, "type": "Feature"}
        return dict(sorted(made.items(), key=lambda _: rng.random()))

    whole = {"type": "FeatureCollection", "crs": {"properties": {"features": [{"a": 1}]}, "links": [{"b": 2}]}} if head else {}
    whole["features"] = [feature(k) for k in range(n)]
    if tail:
        whole |= {"bbox": [1, 2], "links": [{"properties": {"id": "no"}}], "after": {"features": [{"c": []}]}}
    return whole, json.dumps(whole, indent=indent, ensure_ascii=rng.random() < 0.5).encode()


def found(data, step):
    def read(begin, end):
        return data[begin:end]

    own = [r.Range("f", at, min(len(data), at + step)) for at in range(0, len(data), step)]
    states = r.borders(own, [r.outline(read, o.begin, o.end) for o in own])
    return [json.loads(f) for one in states for f in r.features_in(read, len(data), one)]


@pytest.mark.parametrize("seed", range(8))
def test_every_border_gives_every_feature_once(seed, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(r, "MORE_BYTES", rng.choice([7, 64, 1 << 20]))
    whole, data = document(rng, rng.choice([0, 1, 9]), rng.choice([None, 1]), seed % 2 == 0, seed % 3 == 0)
    for step in [1, 2, 3, 5, 17, 63, 64, 65, 200, 1000, len(data) - 1, len(data), len(data) + 9]:
        if step >= 17 or len(data) < 3_000:
            assert found(data, step) == whole["features"], step


def test_long_runs_of_backslashes():
    for n in range(60, 70):
        whole = {"features": [{"t": "\\" * n + '"{['}, {"t": "\\" * n}, {"t": 1}]}
        data = json.dumps(whole).encode()
        for step in (1, 3, 64, 100):
            assert found(data, step) == whole["features"]


def test_documents_without_features():
    for text in ["", " ", "{}", "[]", '{"features": []}', '{"features": null}', '{"features": {"features": [{}]}}', '"features"']:
        for step in (1, 4, 100):
            assert found(text.encode(), step) == []


def test_one_collection_by_several_tasks(spark, tmp_path):
    rng = random.Random(99)
    whole, data = document(rng, 400)
    (tmp_path / "a.json").write_bytes(data)
    (tmp_path / "b.json").write_bytes(document(rng, 3)[1])
    (tmp_path / "c.json").write_bytes(b"{}")
    path = str(tmp_path)
    once = files.scan_geojson(spark, path, "id string, text string", "point")
    split = files.scan_geojson(spark, path, "id string, text string", "point", range_bytes=4_000)
    old = spark.read.schema(
        "features array<struct<properties: struct<id: string, text: string>, geometry: struct<coordinates: array<double>>>>"
    ).option("multiLine", True).json(path).select(F.explode("features").alias("f"))
    old = old.select("f.properties.*", F.col("f.geometry.coordinates")[0].alias("x"), F.col("f.geometry.coordinates")[1].alias("y"))
    assert rows(split) == rows(once) == rows(old) and len(rows(old)) == 403
    tasks = split.withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()
    assert len(tasks) > 10 and max(t["count"] for t in tasks) < 60


def test_packed_collections_are_read_whole(spark, tmp_path):
    import gzip

    whole, data = document(random.Random(5), 7)
    (tmp_path / "a.json.gz").write_bytes(gzip.compress(data))
    assert files.scan_geojson(spark, str(tmp_path), "id string", "point").count() == 7


def zipped(members):
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, text in members.items():
            archive.writestr(name, text)
    return held.getvalue()


CELLS = [["1", 'W "52" St', "a,b"], ["2", "two\nlines", ""], ["NULL", "NA", "x"], ["", "  pad ", "\\"], ["5", "é\r\nü", "''"]]


def table_text(header, lines, end):
    held = io.StringIO()
    csv.writer(held, lineterminator=end).writerows([header, *lines])
    return held.getvalue()


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_lines_of_zipped_tables(spark, tmp_path, end):
    one = zipped({"notes.txt": "x", "t.csv": "﻿" + table_text([" a ", "b", "c"], CELLS, end)})
    two = zipped({"t.csv": table_text(["c", "z", "a"], [["7", "8", "9"]], end) + end, "u.csv": "a"})
    (tmp_path / "one.zip").write_bytes(one)
    (tmp_path / "two.zip").write_bytes(two)
    (tmp_path / "none.zip").write_bytes(zipped({}))
    wanted = ["a", "c", "b"]
    want = [(*[None if v in r.NO_VALUE else v for v in (a, c, b)], "one.zip") for a, b, c in CELLS] + [("9", "7", None, "two.zip")]
    got = r.cells_of(r.zipped_lines(spark, r.listed(spark, f"{tmp_path}/*.zip"), wanted), wanted)
    assert got.rdd.getNumPartitions() == 3
    named = got.withColumn("path", F.element_at(F.split("path", "/"), -1))
    key = lambda row: tuple(map(str, row))
    assert sorted(map(tuple, named.collect()), key=key) == sorted(want, key=key)
    # the same from contents
    held = spark.createDataFrame([("one.zip", one), ("two.zip", two), ("none.zip", zipped({}))], "path string, content binary")
    assert sorted(map(tuple, files.unzip_largest(held, wanted).collect()), key=key) == sorted(want, key=key)


def test_a_stray_quote_takes_no_more_than_a_piece(monkeypatch):
    monkeypatch.setattr(r, "OPEN_QUOTE", 50)
    text = "a,b\n1,\"x\n" + "".join(f"{k},y\n" for k in range(100))
    lines = [line for _, line in r.table_lines(io.BytesIO(zipped({"t.csv": text})), ["a", "b"])]
    assert len(lines) > 80 and lines[-1] == "99,y"
