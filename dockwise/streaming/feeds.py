"""The two feeds that arrive over time, under Structured Streaming.

Stateful steps remember the last row per key and hold newer rows until the
watermark has passed them, so they give the batch result for input that arrives
out of order by no more than `delay`; rows that come later still are dropped, as
by any watermark. Only the key, the order and the looked-up columns enter the
state step. A key's state is what it sent within the delay, and the source's
`maxFilesPerTrigger` or `maxBytesPerTrigger` bounds what a trigger adds to it.

A feed that ends leaves its last rows behind the watermark. `flush_rows` makes
the row that moves the watermark past them all.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dockwise.functions.calendar import micros_between
from dockwise.operators.counters import DELTA_CAP, MAX_GAP_HOURS, plausible_delta
from dockwise.operators.joins import anti_join_new
from dockwise.sources.files import LOCAL_COLONS, capture_path, status_rows
from dockwise.sources.schemas import STATION_STATUS

_EPOCH = "1970-01-01 00:00:00"


def _micros(ts: Column) -> Column:
    """Microseconds of a zone-less timestamp since the start of 1970."""
    return micros_between(F.lit(_EPOCH).cast("timestamp_ntz"), ts)


def _moment(micros: str) -> Column:
    """The zone-less timestamp of microseconds since the start of 1970."""
    seconds = F.col(micros).cast("decimal(18,0)") / F.lit(1_000_000).cast("decimal(18,0)")
    return F.lit(_EPOCH).cast("timestamp_ntz") + F.make_dt_interval(
        secs=seconds.cast("decimal(18,6)")
    )


def _instant(ts: str) -> Column:
    """Watermarks need an instant: the one whose UTC clock shows the row's time."""
    return F.timestamp_micros(_micros(F.col(ts)))


# Fixed value: the time of a row that only moves the watermark.
FLUSH_TIME = "2250-01-01 00:00:00"


def flush_rows(like: DataFrame, ts: str) -> DataFrame:
    """One row of a feed's columns, all null but a time far ahead of any read.

    Written into a feed's source after its last rows, it lets the watermark pass
    them: held rows and open days come out. The row itself never does.
    """
    at = F.lit(FLUSH_TIME).cast(like.schema[ts].dataType)
    return like.sparkSession.range(1).select(
        *[at.alias(f.name) if f.name == ts else F.lit(None).cast(f.dataType).alias(f.name) for f in like.schema]
    )


def _plain(column: pd.Series) -> list:
    """Values as Python's own, null as None; whole numbers that came as floats, for their nulls, are whole again."""
    if column.dtype.kind == "f":
        return [None if v != v else int(v) for v in column.tolist()]
    if column.dtype.kind in "iub":
        return column.tolist()
    return [None if v is None or v != v else v for v in column.tolist()]


def _with_previous_in_state(
    stream: DataFrame, key: str, ts: str, tie: str, values: Sequence[str], delay: str
) -> DataFrame:
    """Key, tie and `ts` in microseconds, with every value and its predecessor."""
    values = list(values)
    narrow = stream.select(
        key,
        tie,
        _micros(F.col(ts)).alias("micros"),
        *[F.col(v).cast("long").alias(v) for v in values],
        _instant(ts).alias("_instant"),
    ).withWatermark("_instant", delay)
    held = ["micros", *values]
    previous = [f"previous_{c}" for c in held]
    flush = int((pd.Timestamp(FLUSH_TIME) - pd.Timestamp("1970-01-01")).total_seconds()) * 1_000_000
    fields = [f for f in narrow.schema.fields if f.name != "_instant"]
    output = ", ".join(
        [f"{f.name} {f.dataType.simpleString()}" for f in fields] + [f"{p} long" for p in previous]
    )

    def carry(group: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        last, waiting = [None] * len(held), []
        if state.exists:
            *last, text = state.get
            waiting = json.loads(text)
        for batch in batches:
            waiting += [list(row) for row in zip(*[_plain(batch[c]) for c in (tie, *held)])]
        if group[0] is None:  # the row that `flush_rows` makes has its time and nothing else
            waiting = [w for w in waiting if not (w[1] == flush and w[0] is None and all(v is None for v in w[2:]))]
        passed = state.getCurrentWatermarkMs() * 1000
        # a row without a time has no predecessor and is none
        timeless = [w for w in waiting if w[1] is None]
        timed = [w for w in waiting if w[1] is not None]
        ready = sorted((w for w in timed if w[1] < passed), key=lambda w: (w[1], w[0] is not None, w[0]))
        waiting = [w for w in timed if w[1] >= passed]
        out = [(*w, *[None] * len(held)) for w in timeless]
        for row in ready:
            out.append((*row, *last))
            last = row[1:]
        if waiting or last[0] is not None:
            state.update((*last, json.dumps(waiting)))
        elif state.exists:
            state.remove()
        if waiting:
            state.setTimeoutTimestamp(min(w[1] for w in waiting) // 1000 + 1)
        if out:
            # object columns: there are many small groups, and typed ones cost each of them milliseconds
            columns = [[group[0]] * len(out), *zip(*out)]
            names = [key, tie, *held, *previous]
            yield pd.DataFrame({n: pd.Series(c, dtype=object) for n, c in zip(names, columns)})

    kept = [f"{c} long" for c in held] + ["waiting string"]
    return narrow.groupBy(key).applyInPandasWithState(
        carry, output, ", ".join(kept), "append", "EventTimeTimeout"
    )


def stream_net_counts(
    stream: DataFrame,
    cap: int = DELTA_CAP,
    max_gap: float = MAX_GAP_HOURS,
    unit: str = "unit_id",
    ts: str = "observed_at",
    tie: str = "id",
    counters: Sequence[str] = ("entries", "exits"),
    delay: str = "1 day",
) -> DataFrame:
    """Net counts of each read against the unit's read before, in order of time.

    A read comes out once the watermark, `delay` behind the newest read, has passed it.
    """
    rows = _with_previous_in_state(stream, unit, ts, tie, counters, delay)
    gap = (F.col("micros") - F.col("previous_micros")) / F.lit(3.6e9)
    rows = rows.withColumn("hours_difference", gap)
    nets = [
        plausible_delta(
            F.col(c) - F.col(f"previous_{c}"), F.col("hours_difference"), cap, max_gap
        ).cast("long").alias(f"net_{c}")
        for c in counters
    ]
    return rows.select(
        unit, tie, _moment("micros").alias(ts), *counters, *nets, "hours_difference"
    )


def stream_stale_flag(
    stream: DataFrame,
    station: str = "station_id",
    ts: str = "reported_datetime",
    tie: str = "objectid",
    delay: str = "1 day",
) -> DataFrame:
    """1 when a report carries the time of the station's report before, else 0."""
    rows = _with_previous_in_state(stream, station, ts, tie, [], delay)
    same = F.col("previous_micros") == F.col("micros")
    return rows.select(
        station, tie, _moment("micros").alias(ts), F.when(same, 1).otherwise(0).alias("stale")
    )


def stream_service_day_totals(
    stream: DataFrame,
    delay: str = "1 day",
    unit: str = "unit_id",
    ts: str = "observed_at",
    counters: Sequence[str] = ("entries", "exits"),
) -> DataFrame:
    """Totals per unit and service day, a day of 24 hours from two in the morning.

    A day is given out once the watermark has passed its end; later rows of
    that day are dropped. `flush_rows` closes the days that are still open.
    """
    timed = stream.withColumn("_instant", _instant(ts)).withWatermark("_instant", delay)
    day = F.window("_instant", "1 day", startTime="2 hours").alias("_day")
    sums = [F.sum(f"net_{c}").alias(c) for c in counters]
    totals = timed.groupBy(unit, day).agg(*sums)
    start = totals.withColumn("_start", F.unix_micros("_day.start"))
    return start.select(unit, F.to_date(_moment("_start")).alias("date"), *counters)


def stream_status_ingest(
    spark: SparkSession,
    source: str,
    out: str,
    checkpoint: str,
    zone: str = "America/New_York",
    files_per_trigger: int = 1000,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append the rows of each new capture file to a table, every file once."""
    feed = (
        spark.readStream.schema(STATION_STATUS)
        .option("multiLine", True)
        .options(**LOCAL_COLONS)
        .option("maxFilesPerTrigger", files_per_trigger)
        .json(source)
    )
    rows = status_rows(feed.withColumn("_file", capture_path()), F.col("_file"), zone)
    return append_stream(rows, out, checkpoint, trigger)


def append_stream(
    rows: DataFrame, out: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Write a stream to a table; by default all that is there now, then stop."""
    return (
        rows.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def new_stations(batch: DataFrame, existing: DataFrame, key: str, order: str) -> DataFrame:
    """Stations of a batch that the table lacks, the first seen of each.

    Of rows of one time the smallest by the remaining columns counts; rows without a
    time come after all others.
    """
    rest = [c for c in batch.columns if c not in (key, order)]
    line = F.struct(F.col(order).isNull().alias("_late"), F.col(order), *rest)
    firsts = batch.groupBy(key).agg(F.min(line).alias("_row"))
    columns = [F.col(key) if c == key else F.col(f"_row.{c}") for c in batch.columns]
    return anti_join_new(firsts.select(*columns), existing, key)


def append_new_stations(
    stream: DataFrame,
    table: str,
    checkpoint: str,
    key: str = "station_id",
    order: str = "seen_at",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Add stations to a table when they are first seen; the first seen stays.

    A trigger that runs again finds its stations in the table and adds nothing.
    """
    schema = stream.schema

    def add(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        try:
            existing = spark.read.schema(schema).parquet(table)
        except AnalysisException as error:  # the table does not exist before the first trigger
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            existing = spark.createDataFrame([], schema)
        new_stations(batch, existing, key, order).write.mode("append").parquet(table)

    return (
        stream.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
