"""Streaming operators over the event file, each run until all of it is read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bindings.files import STATUS_COLUMNS, STATUS_ROWS, capture_files
from bindings.registry import bind, sql, table
from dockwise.session import work_dir
from dockwise.streaming import feeds


def _stream(spark, sf, view) -> DataFrame:
    """A bound view over the event stream."""
    schema = table(spark, sf, "events").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
    events = reader.parquet(sf)
    return view(events)


#: Parts that a feed arrives in, and files of a part.
PARTS, FILES = 3, 4
#: A row arrives up to half a day after its time, so none of them comes too late.
DISORDER_HOURS, DELAY = 12, "1 day"


def _disordered(spark, sf, view, ts: str) -> DataFrame:
    """A bound view over the events as a feed out of order, and the row that flushes it.

    Every row arrives by a hash of its id up to DISORDER_HOURS after its time. What arrives
    within a third of the events' time is a part of several files, read by one trigger.
    """
    rows, source = view(table(spark, sf, "events")), work_dir(spark, "feed")
    late = F.pmod(F.xxhash64(rows.columns[0]), F.lit(DISORDER_HOURS * 3600))
    arrival = F.unix_seconds(F.col(ts).cast("timestamp")) + late
    span = rows.agg(F.min(arrival).alias("a"), F.max(arrival).alias("b")).first()
    part = F.least(F.floor((arrival - span["a"]) * PARTS / (span["b"] - span["a"] + 1)), F.lit(PARTS - 1))
    for number in range(PARTS):
        rows.filter(part == number).repartition(FILES).write.mode("append").parquet(source)
    feeds.flush_rows(rows, ts).coalesce(1).write.mode("append").parquet(source)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", FILES).parquet(source)


def _run(spark, rows: DataFrame, name: str) -> DataFrame:
    out = work_dir(spark, name)
    feeds.append_stream(rows, f"{out}/rows", f"{out}/checkpoint").awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{out}/rows")


def _reads(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("unit_id"),
        F.col("ts").alias("observed_at"),
        F.round(F.col("value") * 100).cast("long").alias("entries"),
        F.get_json_object("props", "$.k").cast("long").alias("exits"),
    )


def _reports(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").alias("objectid"),
        F.col("user_id").alias("station_id"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("reported_datetime"),
    )


@bind(
    "stream_net_counts",
    sql(
        """
        SELECT id, unit_id, observed_at, entries, exits, net_entries, net_exits, hours_difference
        FROM net
        """
    ),
)
def stream_net_counts(spark, sf):
    feed = _disordered(spark, sf, _reads, "observed_at")
    return _run(spark, feeds.stream_net_counts(feed, delay=DELAY), "net")


@bind(
    "stream_stale_flag",
    sql("SELECT objectid, station_id, reported_datetime, stale FROM flagged"),
)
def stream_stale_flag(spark, sf):
    feed = _disordered(spark, sf, _reports, "reported_datetime")
    return _run(spark, feeds.stream_stale_flag(feed, delay=DELAY), "stale")


@bind(
    "stream_service_day_totals",
    """
    SELECT user_id AS unit_id, CAST(ts - INTERVAL 2 HOURS AS DATE) AS date,
           CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS entries,
           CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS exits
    FROM events GROUP BY ALL
    """,
)
def stream_service_day_totals(spark, sf):
    """All days, the last ones closed by the row that flushes the feed."""
    counted = _disordered(spark, sf, _reads, "observed_at").withColumns(
        {"net_entries": F.col("entries"), "net_exits": F.col("exits")}
    )
    return _run(spark, feeds.stream_service_day_totals(counted, delay=DELAY), "days")


@bind("stream_status_ingest", STATUS_ROWS)
def stream_status_ingest(spark, sf):
    out = work_dir(spark, "ingest")
    feeds.stream_status_ingest(
        spark, capture_files(spark, sf), f"{out}/rows", f"{out}/checkpoint"
    ).awaitTermination()
    return spark.read.parquet(f"{out}/rows").select(*STATUS_COLUMNS)


@bind(
    "append_new_stations",
    """
    SELECT user_id AS station_id, arg_min(event_type, (ts, event_type)) AS name, min(ts) AS seen_at
    FROM events GROUP BY ALL
    """,
)
def append_new_stations(spark, sf):
    out = work_dir(spark, "stations")

    def seen(events: DataFrame) -> DataFrame:
        return events.select(
            F.col("user_id").alias("station_id"),
            F.col("event_type").alias("name"),
            F.col("ts").alias("seen_at"),
        )

    stream = _stream(spark, sf, seen)
    feeds.append_new_stations(stream, f"{out}/table", f"{out}/checkpoint").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{out}/table")
