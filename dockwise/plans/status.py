"""Station-status pipeline: reports to availability summaries of all periods."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dockwise.functions.calendar import STATION_PERIODS
from dockwise.operators.joins import inner_join_station
from dockwise.operators.stations import (
    AVAILABILITY,
    STALE_LIMIT,
    availability_counts,
    availability_ratios,
    availability_shares,
    stale_flag,
    tag_station_periods,
)


def status_summaries(
    status: DataFrame,
    station: DataFrame,
    periods: Sequence[str] = STATION_PERIODS,
    stale_limit: float = STALE_LIMIT,
    tie: Sequence[str] = ("objectid",),
) -> DataFrame:
    """One row per period and station that reports often enough.

    The stale share counts every report of a station, which is what the `all`
    period counts, so the one aggregation serves both and the reports are
    shuffled once for the flag and once, pre-aggregated, for the summaries.
    """
    flagged = stale_flag(status, tie=tie)
    joined = inner_join_station(flagged, station, cols=["capacity"])
    wanted = list(dict.fromkeys(["all", *periods]))
    tagged = tag_station_periods(availability_shares(joined), wanted)
    keys = ("period", "station_id")
    stale = F.count_if(F.col("stale") == 1).alias("_stale")
    counts = availability_counts(tagged, AVAILABILITY, keys, stale)
    share = F.when(F.col("period") == "all", F.col("_stale") / F.col("total"))
    of_station = F.max(share).over(W.partitionBy("station_id"))
    fresh = counts.withColumn("_share", of_station).filter(F.col("_share") < stale_limit)
    return availability_ratios(fresh.filter(F.col("period").isin(*periods)), AVAILABILITY, keys)
