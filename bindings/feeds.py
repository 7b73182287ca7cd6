"""Station-status operators on events and customer."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.registry import bind, sql, station, status, table
from dockwise.functions.calendar import STATION_PERIODS, calendar_parts, station_period, tag_periods
from dockwise.operators import joins as j
from dockwise.operators import stations as s
from dockwise.plans.status import status_summaries

LIMIT = 0.08  # the events repeat an hour far less often than a feed repeats a report


def flagged(spark, sf):
    rows = s.stale_flag(status(spark, sf))
    return rows.withColumns(
        {
            "reported_hour": F.hour("reported_datetime"),
            "reported_weekday": F.weekday("reported_datetime"),
        }
    )


def reports(spark, sf):
    joined = j.inner_join_station(flagged(spark, sf), station(spark, sf), cols=["capacity"])
    return s.availability_shares(joined)


@bind("stale_flag", sql("SELECT objectid, station_id, reported_datetime, stale FROM flagged"))
def stale_flag(spark, sf):
    rows = s.stale_flag(status(spark, sf))
    return rows.select("objectid", "station_id", "reported_datetime", "stale")


SHARE = """
    SELECT station_id, CAST(sum(stale) AS DOUBLE) / count(*) AS stale_percent
    FROM flagged GROUP BY station_id
"""


@bind("stale_share", sql(SHARE))
def stale_share(spark, sf):
    return s.stale_share(flagged(spark, sf))


@bind("having_stale_share", sql(f"SELECT * FROM ({SHARE}) WHERE stale_percent < {LIMIT}"))
def having_stale_share(spark, sf):
    return s.having_stale_share(s.stale_share(flagged(spark, sf)), LIMIT)


@bind(
    "semi_join_in",
    sql(
        f"""
        SELECT objectid, station_id, stale FROM flagged
        WHERE station_id IN (SELECT station_id FROM ({SHARE}) WHERE stale_percent < {LIMIT})
        """
    ),
)
def semi_join_in(spark, sf):
    rows = flagged(spark, sf)
    fresh = s.having_stale_share(s.stale_share(rows), LIMIT)
    return j.semi_join_in(rows.select("objectid", "station_id", "stale"), fresh, "station_id")


@bind(
    "inner_join_station",
    sql("SELECT objectid, station_id, num_bikes_available, capacity FROM status JOIN (SELECT * FROM station WHERE x > 0) USING (station_id)"),
)
def inner_join_station(spark, sf):
    rows = status(spark, sf).select("objectid", "station_id", "num_bikes_available")
    return j.inner_join_station(rows, station(spark, sf).filter("x > 0"), cols=["capacity"])


@bind("station_period", sql("SELECT period, objectid FROM period_reports"))
def periods_of_station(spark, sf):
    tagged = tag_periods(reports(spark, sf), {p: station_period(p) for p in STATION_PERIODS})
    return tagged.select("period", "objectid")


@bind(
    "calendar_parts",
    """
    SELECT event_id, ts AS seen_datetime, CAST(ts AS DATE) AS seen_date,
           CAST(year(ts) AS INTEGER) AS seen_year, CAST(month(ts) AS INTEGER) AS seen_month,
           CAST(day(ts) AS INTEGER) AS seen_day, strftime(ts, '%H:%M:%S') AS seen_time,
           CAST(hour(ts) AS INTEGER) AS seen_hour, CAST(minute(ts) AS INTEGER) AS seen_minute,
           CAST(second(ts) AS INTEGER) AS seen_second,
           CAST(isodow(ts) - 1 AS INTEGER) AS seen_weekday
    FROM events
    """,
)
def parts(spark, sf):
    return calendar_parts(table(spark, sf, "events").select("event_id", "ts"), "ts", "seen").drop("ts")


# the conditions as the users' table has them, written out apart from the library's
CONDITIONS = """
    count_eq0_bikes_available  bikes_available_eq0              num_bikes_available = 0
    count_eq1_bikes_available  bikes_available_eq1              num_bikes_available = 1
    count_lte3_bikes_available bikes_available_lte3             num_bikes_available <= 3
    count_lte5_bikes_available bikes_available_lte5             num_bikes_available <= 5
    count_eq0_docks_available  docks_available_eq0              num_docks_available = 0
    count_eq1_docks_available  docks_available_eq1              num_docks_available = 1
    count_lte3_docks_available docks_available_lte3             num_docks_available <= 3
    count_lte5_docks_available docks_available_lte5             num_docks_available <= 5
    count_0                    capacity_available_eq_0percent   perc_capacity_available = 0::DOUBLE
    count_10                   capacity_available_lt_10percent  perc_capacity_available <= 0.1::DOUBLE
    count_25                   capacity_available_lt_25percent  perc_capacity_available <= 0.25::DOUBLE
    count_lt50                 capacity_available_lt_50percent  perc_capacity_available <= 0.5::DOUBLE
    count_gt50                 capacity_available_gt_50percent  perc_capacity_available >= 0.5::DOUBLE
    count_gt75                 capacity_available_gt_75percent  perc_capacity_available >= 0.75::DOUBLE
    count_gt90                 capacity_available_gt_90percent  perc_capacity_available >= 0.9::DOUBLE
    count_100                  capacity_available_eq_100percent perc_capacity_available = 100::DOUBLE
    counte_0                   enabled_available_eq_0percent    perc_enabled_available = 0::DOUBLE
    counte_10                  enabled_available_lt_10percent   perc_enabled_available <= 0.1::DOUBLE
    counte_25                  enabled_available_lt_25percent   perc_enabled_available <= 0.25::DOUBLE
    counte_lt50                enabled_available_lt_50percent   perc_enabled_available <= 0.5::DOUBLE
    counte_gt50                enabled_available_gt_50percent   perc_enabled_available >= 0.5::DOUBLE
    counte_gt75                enabled_available_gt_75percent   perc_enabled_available >= 0.75::DOUBLE
    counte_gt90                enabled_available_gt_90percent   perc_enabled_available >= 0.9::DOUBLE
    counte_100                 enabled_available_eq_100percent  perc_enabled_available = 100::DOUBLE
"""
_LINES = [line.split(None, 2) for line in CONDITIONS.strip().splitlines()]
COUNTS = (
    "SELECT period, station_id, count(*) AS total, "
    + ", ".join(f"count(*) FILTER ({condition}) AS {count}" for count, _, condition in _LINES)
    + ", round(avg(CAST(perc_capacity_available AS DECIMAL(18, 12))), 3)"
    " AS avg_perc_capacity_available"
    ", round(avg(CAST(perc_enabled_available AS DECIMAL(18, 12))), 3) AS avg_perc_enabled_available"
    " FROM period_reports GROUP BY period, station_id"
)


@bind("availability_counts", sql(COUNTS))
def availability_counts(spark, sf):
    return s.availability_counts(s.tag_station_periods(reports(spark, sf)))


RATIOS = (
    "SELECT period, station_id, "
    + ", ".join(f"round(CAST({count} AS DOUBLE) / total, 3) AS {ratio}" for count, ratio, _ in _LINES)
    + ", avg_perc_capacity_available, avg_perc_enabled_available FROM (" + COUNTS + ")"
)


@bind("availability_ratios", sql(RATIOS))
def availability_ratios(spark, sf):
    counts = s.availability_counts(s.tag_station_periods(reports(spark, sf)))
    return s.availability_ratios(counts)


def _summaries(spark, sf):
    rows = status(spark, sf).withColumns(
        {
            "reported_hour": F.hour("reported_datetime"),
            "reported_weekday": F.weekday("reported_datetime"),
        }
    )
    return status_summaries(rows, station(spark, sf), stale_limit=LIMIT)


FRESH = (
    f"SELECT * FROM ({RATIOS}) WHERE station_id IN"
    f" (SELECT station_id FROM ({SHARE}) WHERE stale_percent < {LIMIT})"
)


@bind("status_pipeline", sql(FRESH))
def summaries(spark, sf):
    return _summaries(spark, sf)


@bind(
    "join_summary_geometry",
    sql(f"SELECT f.*, x, y FROM ({FRESH}) f JOIN station USING (station_id)"),
)
def join_summary_geometry(spark, sf):
    return j.join_summary_geometry(_summaries(spark, sf), station(spark, sf))


@bind("latest_capture", "SELECT max(ts) AS capture_datetime FROM events")
def latest_capture(spark, sf):
    return s.latest_capture(status(spark, sf))


@bind(
    "incremental_captures",
    sql(
        """
        SELECT objectid, station_id, capture_datetime FROM status
        WHERE capture_datetime > (SELECT max(capture_datetime) FROM status
                                  WHERE capture_datetime < TIMESTAMP '2024-01-16')
        """
    ),
)
def incremental_captures(spark, sf):
    rows = status(spark, sf).select("objectid", "station_id", "capture_datetime")
    loaded = rows.filter(F.col("capture_datetime") < F.lit("2024-01-16").cast("timestamp_ntz"))
    return s.incremental_captures(rows, loaded)


@bind(
    "update_from_subquery",
    sql(
        """
        SELECT objectid, (SELECT stale FROM flagged f
                          WHERE f.objectid = status.objectid AND f.stale = 1) AS stale
        FROM status
        """
    ),
)
def update_from_subquery(spark, sf):
    rows = status(spark, sf).select("objectid", F.lit(None).cast("int").alias("stale"))
    values = flagged(spark, sf).filter("stale = 1")
    return j.update_from_subquery(rows, values, "objectid", ["stale"])
