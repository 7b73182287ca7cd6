"""Station status: flattening, staleness and availability summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockwise.functions.calendar import STATION_PERIODS, station_period, tag_periods
from dockwise.operators.ordered import RUN, RUN_DAYS, with_previous

STALE_LIMIT = 0.70

# The counted conditions of a summary, as
# (count column, ratio column, measure, comparison, limit).
# The ratio names say lt, gt and 100 percent while the conditions are at most,
# at least and a share of 100; both are part of the table users know.
AVAILABILITY = (
    ("count_eq0_bikes_available", "bikes_available_eq0", "num_bikes_available", "=", 0),
    ("count_eq1_bikes_available", "bikes_available_eq1", "num_bikes_available", "=", 1),
    ("count_lte3_bikes_available", "bikes_available_lte3", "num_bikes_available", "<=", 3),
    ("count_lte5_bikes_available", "bikes_available_lte5", "num_bikes_available", "<=", 5),
    ("count_eq0_docks_available", "docks_available_eq0", "num_docks_available", "=", 0),
    ("count_eq1_docks_available", "docks_available_eq1", "num_docks_available", "=", 1),
    ("count_lte3_docks_available", "docks_available_lte3", "num_docks_available", "<=", 3),
    ("count_lte5_docks_available", "docks_available_lte5", "num_docks_available", "<=", 5),
    ("count_0", "capacity_available_eq_0percent", "perc_capacity_available", "=", 0.0),
    ("count_10", "capacity_available_lt_10percent", "perc_capacity_available", "<=", 0.10),
    ("count_25", "capacity_available_lt_25percent", "perc_capacity_available", "<=", 0.25),
    ("count_lt50", "capacity_available_lt_50percent", "perc_capacity_available", "<=", 0.50),
    ("count_gt50", "capacity_available_gt_50percent", "perc_capacity_available", ">=", 0.50),
    ("count_gt75", "capacity_available_gt_75percent", "perc_capacity_available", ">=", 0.75),
    ("count_gt90", "capacity_available_gt_90percent", "perc_capacity_available", ">=", 0.90),
    ("count_100", "capacity_available_eq_100percent", "perc_capacity_available", "=", 100.0),
    ("counte_0", "enabled_available_eq_0percent", "perc_enabled_available", "=", 0.0),
    ("counte_10", "enabled_available_lt_10percent", "perc_enabled_available", "<=", 0.10),
    ("counte_25", "enabled_available_lt_25percent", "perc_enabled_available", "<=", 0.25),
    ("counte_lt50", "enabled_available_lt_50percent", "perc_enabled_available", "<=", 0.50),
    ("counte_gt50", "enabled_available_gt_50percent", "perc_enabled_available", ">=", 0.50),
    ("counte_gt75", "enabled_available_gt_75percent", "perc_enabled_available", ">=", 0.75),
    ("counte_gt90", "enabled_available_gt_90percent", "perc_enabled_available", ">=", 0.90),
    ("counte_100", "enabled_available_eq_100percent", "perc_enabled_available", "=", 100.0),
)
AVERAGES = ("avg_perc_capacity_available", "avg_perc_enabled_available")
VALET_FIELDS = {
    "valet_revision": "valet_revision",
    "active": "valet_active",
    "off_dock_count": "valet_off_dock_count",
    "off_dock_capacity": "valet_off_dock_capacity",
    "dock_blocked_count": "valet_dock_blocked_count",
}


def flatten_status(df: DataFrame) -> DataFrame:
    """Lift the optional valet object to columns; drop it and the service list."""
    lifted = {name: F.col(f"valet.{field}") for field, name in VALET_FIELDS.items()}
    return df.withColumns(lifted).drop("valet", "eightd_active_station_services")


def stale_flag(
    df: DataFrame,
    station: str = "station_id",
    ts: str = "reported_datetime",
    tie: Sequence[str] = ("objectid",),
    run_days: int = RUN_DAYS,
) -> DataFrame:
    """Add `stale`: 1 when the station's report before carries the same time, else 0."""
    dated = df.withColumn("_report_day", F.to_date(ts))
    order = [ts, *[c for c in tie if c in df.columns]]
    rows = with_previous(dated, station, order, [ts], "_report_day", run_days=run_days)
    same = F.col(f"previous_{ts}") == F.col(ts)
    flagged = rows.withColumn("stale", F.when(same, 1).otherwise(0))
    return flagged.drop(f"previous_{ts}", RUN, "_report_day")


def stale_share(status: DataFrame, station: str = "station_id") -> DataFrame:
    """Share of stale rows per station."""
    share = F.count_if(F.col("stale") == 1) / F.count(F.lit(1))
    return status.groupBy(station).agg(share.alias("stale_percent"))


def having_stale_share(df: DataFrame, limit: float = STALE_LIMIT) -> DataFrame:
    """Stations that update often enough."""
    return df.filter(F.col("stale_percent") < limit)


def availability_shares(df: DataFrame, capacity: str = "capacity") -> DataFrame:
    """Bikes as a share of the capacity, and of the docks in service."""
    bikes, docks = F.col("num_bikes_available"), F.col("num_docks_available")
    return df.withColumns(
        {
            "perc_capacity_available": F.try_divide(
                bikes.cast("double"), F.col(capacity).cast("double")
            ),
            "perc_enabled_available": F.try_divide(
                bikes.cast("double"), (docks + bikes).cast("double")
            ),
        }
    )


def _holds(measure: str, comparison: str, limit: float) -> Column:
    value = F.col(measure)
    if comparison == "=":
        return value == limit
    return value <= limit if comparison == "<=" else value >= limit


def _mean_share(share: str) -> Column:
    """Mean to three places. Summed as decimals: the order of the rows cannot tip a rounding."""
    return F.round(F.avg(F.col(share).cast("decimal(18,12)")), 3).cast("double")


def availability_counts(
    status: DataFrame,
    thresholds=AVAILABILITY,
    by: Sequence[str] = ("period", "station_id"),
    *more: Column,
) -> DataFrame:
    """Rows per condition, total and mean shares per group, in one aggregation."""
    counts = [F.count_if(_holds(m, op, lim)).alias(c) for c, _, m, op, lim in thresholds]
    means = [_mean_share(a.removeprefix("avg_")).alias(a) for a in AVERAGES]
    return status.groupBy(*by).agg(F.count(F.lit(1)).alias("total"), *counts, *means, *more)


def availability_ratios(
    counts: DataFrame, thresholds=AVAILABILITY, by: Sequence[str] = ("period", "station_id")
) -> DataFrame:
    """Each count as a share of the total, rounded to three places."""
    ratios = [F.round(F.col(c) / F.col("total"), 3).alias(r) for c, r, *_ in thresholds]
    half = sum(1 for c, *_ in thresholds if c.endswith("_available"))
    return counts.select(*by, *ratios[:half], *AVERAGES, *ratios[half:])


def tag_station_periods(status: DataFrame, periods: Sequence[str] = STATION_PERIODS) -> DataFrame:
    """One row per period a status row counts for."""
    return tag_periods(status, {p: station_period(p) for p in periods})


def latest_capture(df: DataFrame, ts_col: str = "capture_datetime") -> DataFrame:
    """The newest capture time, one row."""
    return df.agg(F.max(ts_col).alias(ts_col))


def incremental_captures(
    captures: DataFrame, loaded: DataFrame, ts_col: str = "capture_datetime"
) -> DataFrame:
    """Captures strictly after the newest one loaded; all of them when none is.

    The one newest time comes to the driver, so that the bound is a literal: where the
    time follows from the file's name, older files are not opened.
    """
    newest = latest_capture(loaded, ts_col).first()[0]
    return captures if newest is None else captures.filter(F.col(ts_col) > F.lit(newest))


def report_time(epoch: Column, zone: str = "America/New_York") -> Column:
    """Epoch seconds as a zone-less timestamp of the given zone."""
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    utc = start + F.make_dt_interval(secs=epoch)
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)

