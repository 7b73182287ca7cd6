"""Station status on feeds written by hand."""

import datetime as dt
import gzip
import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from dockwise.operators import stations as s
from dockwise.plans.status import status_summaries
from dockwise.sources import files
from dockwise.streaming import feeds

VALET = {"valet_revision": "1", "active": True, "off_dock_count": 3, "off_dock_capacity": 9, "dock_blocked_count": 0}


def station(number, reported, bikes=1, docks=2, **more):
    return {
        "station_id": number, "legacy_id": f"l{number}", "is_installed": 1, "is_renting": 1,
        "is_returning": 1, "num_bikes_available": bikes, "num_docks_available": docks,
        "eightd_has_available_keys": False, "station_status": "active",
        "eightd_active_station_services": ["x"], "last_reported": reported, **more,
    }


def write_captures(folder, captures):
    folder.mkdir(parents=True, exist_ok=True)
    for name, stations in captures.items():
        with gzip.open(folder / f"{name}.json.gz", "wt") as out:
            json.dump({"data": {"stations": stations}}, out, indent=1)


# 2023-03-06 07:00 in New York is 12:00 in UTC
SEVEN = 1678104000
CAPTURES = {
    "2023-03-06_07:00:30": [station("s", SEVEN, 0, 4, valet=VALET), station("t", SEVEN, 0, 0)],
    "2023-03-06_07:15:30": [station("s", SEVEN, 0, 4), station("t", SEVEN + 900, 2, 2)],
    "2023-03-06_07-30-30": [station("s", SEVEN + 1800, 5, 0), station("t", SEVEN + 1800, 4, 0)],
}


@pytest.fixture(scope="module")
def captured(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("captures")
    write_captures(folder, CAPTURES)
    return files.scan_station_status(spark, str(folder))


def test_scan(captured):
    got = captured.filter("station_id = 's'").orderBy("capture_datetime").collect()
    first, last = got[0], got[-1]
    assert len(got) == 3
    assert first.capture_datetime == dt.datetime(2023, 3, 6, 7, 0, 30)
    assert first.reported_datetime == dt.datetime(2023, 3, 6, 7, 0)
    assert (first.reported_hour, first.reported_weekday, first.reported_time) == (7, 0, "07:00:00")
    assert (first.valet_active, first.valet_off_dock_count) == (True, 3)
    assert last.valet_active is None and last.valet_revision is None
    assert last.capture_datetime == dt.datetime(2023, 3, 6, 7, 30, 30)
    assert "valet" not in captured.columns
    assert "eightd_active_station_services" not in captured.columns


def numbered(captured):
    order = F.concat("station_id", F.col("capture_datetime").cast("string"))
    return captured.withColumn("objectid", order)


def test_stale(captured):
    got = rows(s.stale_flag(numbered(captured)), "station_id", "capture_minute", "stale")
    assert got == [("s", 0, 0), ("s", 15, 1), ("s", 30, 0), ("t", 0, 0), ("t", 15, 0), ("t", 30, 0)]


def test_hot_station(captured):
    cols = ["station_id", "capture_minute", "stale"]
    sliced = s.stale_flag(numbered(captured), run_days=1)
    assert rows(sliced, *cols) == rows(s.stale_flag(numbered(captured)), *cols)


def test_summaries(spark, captured):
    stations = spark.createDataFrame([("s", 10), ("t", 0)], "station_id string, capacity int")
    got = {(r.period, r.station_id): r for r in status_summaries(numbered(captured), stations).collect()}
    assert {p for p, _ in got} == {"all", "morning_peak", "peak"}
    whole, peak = got["all", "s"], got["peak", "s"]
    # the whole day keeps the stale report, the peak leaves it out
    assert (whole.bikes_available_eq0, peak.bikes_available_eq0) == (0.667, 0.5)
    assert (peak.avg_perc_capacity_available, peak.avg_perc_enabled_available) == (0.25, 0.5)
    # the column of 100 percent counts shares of 100, as users know it
    assert peak.enabled_available_eq_100percent == 0.0
    none = got["all", "t"]
    assert none.avg_perc_capacity_available is None  # no docks
    assert none.avg_perc_enabled_available == 0.75  # an empty report has no share


def test_mostly_stale_stations_go(spark):
    reports = [("x", i, dt.datetime(2023, 3, 6, 7, 0)) for i in range(10)]
    reports += [("y", 100 + i, dt.datetime(2023, 3, 6, 7, i // 3)) for i in range(9)]
    status = spark.createDataFrame(reports, "station_id string, objectid int, reported_datetime timestamp_ntz")
    shares = s.stale_share(s.stale_flag(status))
    assert rows(shares) == [("x", 0.9), ("y", 6 / 9)]
    assert rows(s.having_stale_share(shares), "station_id") == [("y",)]


def test_incremental(captured):
    loaded = captured.filter("capture_minute < 30")
    assert s.incremental_captures(captured, loaded).count() == 2
    assert s.incremental_captures(captured, captured).count() == 0
    assert s.incremental_captures(captured, captured.filter("false")).count() == 6


def test_station_info(spark, tmp_path):
    base = {
        "legacy_id": "1", "external_id": "e", "lon": -74.0, "lat": 40 + 10 / 60, "name": "n", "short_name": "m",
        "station_type": "classic", "capacity": 3, "eightd_has_key_dispenser": False, "has_kiosk": True,
        "electric_bike_surcharge_waiver": False,
    }
    stations = [
        {**base, "station_id": "a", "rental_methods": ["KEY", "CREDITCARD"], "region_id": "71"},
        {**base, "station_id": "b", "rental_methods": ["CREDITCARD"]},
        {**base, "station_id": "c", "rental_methods": []},
    ]
    with gzip.open(tmp_path / "info.json.gz", "wt") as out:
        json.dump({"data": {"stations": stations}}, out, indent=1)
    got = files.scan_station_info(spark, str(tmp_path)).orderBy("objectid").collect()
    assert [(r.objectid, r.rental_method_key, r.rental_method_credit, r.region_id) for r in got] == [
        (0, True, True, "71"), (1, False, True, None), (2, False, False, None),
    ]
    # the origin of the projection
    assert abs(got[0].x - 984250.0) < 1e-3 and abs(got[0].y) < 1e-3


def test_stream_equals_batch(spark, tmp_path):
    """Captures that arrive in order, one file per trigger, give the batch tables."""
    folder = tmp_path / "in"
    write_captures(folder, CAPTURES)
    batch = files.scan_station_status(spark, str(folder))
    out = str(tmp_path / "out")
    feeds.stream_status_ingest(
        spark, str(folder), out, str(tmp_path / "cp"), files_per_trigger=1
    ).awaitTermination()
    assert rows(spark.read.parquet(out).select(*batch.columns)) == rows(batch)
    # a second run reads only what came since
    write_captures(folder, {"2023-03-06_07:45:30": [station("s", SEVEN + 1800)]})
    feeds.stream_status_ingest(spark, str(folder), out, str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(out).count() == 7


def test_state_carries_over_triggers(spark, tmp_path):
    import os
    import time

    folder = tmp_path / "reports"
    reports = [  # the third file is late by half an hour
        [("s", "1", "2023-03-06 07:00:00"), ("t", "4", "2023-03-06 07:15:00")],
        [("t", "6", "2023-03-06 07:15:00"), ("s", "5", "2023-03-06 07:30:00")],
        [("t", "2", "2023-03-06 07:00:00"), ("s", "3", "2023-03-06 07:00:00")],
        [(None, None, feeds.FLUSH_TIME)],
    ]
    schema = "station_id string, objectid string, reported_datetime timestamp_ntz"
    for i, part in enumerate(reports):
        texts = spark.createDataFrame(part, "station_id string, objectid string, t string")
        path = str(folder / f"p{i}")
        texts.selectExpr("station_id", "objectid", "cast(t as timestamp_ntz) reported_datetime").coalesce(1).write.parquet(path)
        for name in os.listdir(path):
            moment = time.time() - 600 + 60 * i
            os.utime(os.path.join(path, name), (moment, moment))
    stream = (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
        .option("recursiveFileLookup", True).parquet(str(folder))
    )
    out = str(tmp_path / "out")
    feeds.append_stream(
        feeds.stream_stale_flag(stream, delay="1 hour"), out, str(tmp_path / "cp")
    ).awaitTermination()
    whole = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(str(folder))
    batch = s.stale_flag(whole.filter("objectid IS NOT NULL"))
    cols = ["station_id", "objectid", "reported_datetime", "stale"]
    assert rows(spark.read.parquet(out), *cols) == rows(batch, *cols)
    assert sum(r.stale for r in batch.collect()) == 2


def test_new_stations_once(spark, tmp_path):
    schema = "station_id string, name string, seen_at timestamp_ntz"
    folder = str(tmp_path / "in")

    def add(*stations):
        texts = spark.createDataFrame(stations, "station_id string, name string, t string")
        texts.selectExpr("station_id", "name", "cast(t as timestamp_ntz) seen_at").coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(schema).parquet(folder)
        feeds.append_new_stations(stream, str(tmp_path / "table"), str(tmp_path / "cp")).awaitTermination()
        return rows(spark.read.parquet(str(tmp_path / "table")), "station_id", "name")

    assert add(("a", "later", "2023-01-02"), ("a", "first", "2023-01-01")) == [("a", "first")]
    assert add(("a", "again", "2023-01-03"), ("b", "new", "2023-01-03")) == [("a", "first"), ("b", "new")]
    # one time: the smaller name; no time: after any row with one, and whole
    assert add(("c", "z", "2023-01-03"), ("c", "y", "2023-01-03"), ("d", "no time", None))[2:] == [("c", "y"), ("d", "no time")]


def test_late_rows_never_move_the_state_back(spark, tmp_path):
    """Reads at 0 and 8 hours, then at 4 and 12: the net counts are those of the batch."""
    import os
    import time

    from dockwise.operators.counters import net_counts

    schema = "unit_id string, id string, observed_at timestamp_ntz, entries long, exits long"
    folder = tmp_path / "in"
    for i, hours in enumerate(((0, 8), (4, 12))):
        texts = spark.createDataFrame([("u", f"{h:02d}", f"2023-03-06 {h:02d}:00:00", 50 * h * h, h) for h in hours], "unit_id string, id string, t string, entries long, exits long")
        texts.selectExpr("unit_id", "id", "cast(t as timestamp_ntz) observed_at", "entries", "exits").coalesce(1).write.parquet(str(folder / f"p{i}"))
    whole = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(str(folder))
    want = rows(net_counts(whole), "id", "net_entries", "hours_difference")
    feeds.flush_rows(whole, "observed_at").coalesce(1).write.parquet(str(folder / "p2"))
    for i in range(3):
        for name in os.listdir(folder / f"p{i}"):
            moment = time.time() - 600 + 60 * i
            os.utime(folder / f"p{i}" / name, (moment, moment))
    stream = (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
        .option("recursiveFileLookup", True).parquet(str(folder))
    )
    out = str(tmp_path / "out")
    feeds.append_stream(feeds.stream_net_counts(stream), out, str(tmp_path / "cp")).awaitTermination()
    assert rows(spark.read.parquet(out), "id", "net_entries", "hours_difference") == want
    assert [r[1] for r in want] == [None, 800, 2400, 4000]


def test_hot_unit_in_several_files_a_trigger(spark, tmp_path):
    """A unit with a third of the rows: a delay of an hour, rows in disorder within it, and one too late."""
    import random

    from dockwise.operators.counters import net_counts

    rng = random.Random(8)
    start = 1_700_000_000
    events = []
    for k in range(1_500):
        unit = "hot" if k % 3 == 0 else f"u{rng.randrange(40)}"
        events.append((unit, f"{k:05d}", start + 400 * k + rng.randrange(300), 10 * k + rng.randrange(9), k))
    arrived = sorted(events, key=lambda e: e[2] + rng.randrange(3_000))
    schema = "unit_id string, id string, observed_at timestamp_ntz, entries long, exits long"
    source = str(tmp_path / "in")

    def add(part, files):
        texts = spark.createDataFrame(part, "unit_id string, id string, t long, entries long, exits long")
        rows_ = texts.selectExpr("unit_id", "id", "cast(timestamp_seconds(t) as timestamp_ntz) observed_at", "entries", "exits")
        rows_.repartition(files).write.mode("append").parquet(source)

    for at in range(0, len(arrived), 300):
        add(arrived[at : at + 300], 2)
    whole = spark.read.schema(schema).parquet(source)
    want = rows(net_counts(whole), "id", "net_entries", "net_exits", "hours_difference")
    add([("hot", "late", start, 1, 1)], 1)  # behind the watermark by days
    feeds.flush_rows(whole, "observed_at").coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(source)
    out = str(tmp_path / "out")
    feeds.append_stream(feeds.stream_net_counts(stream, delay="1 hour"), out, str(tmp_path / "cp")).awaitTermination()
    assert rows(spark.read.parquet(out), "id", "net_entries", "net_exits", "hours_difference") == want


def test_rows_of_the_flush_time_are_kept_but_for_the_flush(spark, tmp_path):
    schema = "station_id string, objectid string, reported_datetime timestamp_ntz"
    given = [("s", "1", "2249-12-31 23:00:00"), ("s", "2", feeds.FLUSH_TIME), (None, "3", feeds.FLUSH_TIME)]
    texts = spark.createDataFrame(given, "station_id string, objectid string, t string")
    told = texts.selectExpr("station_id", "objectid", "cast(t as timestamp_ntz) reported_datetime")
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    told.coalesce(1).write.parquet(source)
    feeds.flush_rows(told, "reported_datetime").coalesce(1).write.mode("append").parquet(source)
    after = spark.createDataFrame([("t", "4", "2260-01-01 00:00:00")], "station_id string, objectid string, t string")
    after.selectExpr("station_id", "objectid", "cast(t as timestamp_ntz) reported_datetime").coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    feeds.append_stream(feeds.stream_stale_flag(stream), out, str(tmp_path / "cp")).awaitTermination()
    assert rows(spark.read.parquet(out), "objectid") == [("1",), ("2",), ("3",)]
