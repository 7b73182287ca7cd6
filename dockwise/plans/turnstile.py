"""Turnstile pipeline: reads to daily, monthly, annual and multi-year tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from dockwise.functions.calendar import TRANSIT_PERIODS
from dockwise.operators.clean import reject_null_rows
from dockwise.operators.counters import (
    DAY,
    annual_summary,
    daily_group_totals,
    daily_totals_all_periods,
    monthly_summary,
    grouped_net_counts,
)
from dockwise.operators.joins import (
    centroid_of_group,
    fanout_join_aggregate,
    multi_year_mean,
    multi_year_total,
    multiway_left_join,
)
from dockwise.operators.ordered import RUN
from dockwise.session import settle
from dockwise.sources.schemas import TURNSTILE_REQUIRED

ALL_DAY = "all"


def turnstile_tables(
    observations: DataFrame, lookup: DataFrame, periods: Sequence[str] = TRANSIT_PERIODS
) -> dict[str, DataFrame]:
    """Every table of the pipeline from cleaned reads.

    The daily unit table takes whole days and all periods from one pass: the
    reads are shuffled once, by unit and run of days, for the net counts and the
    totals alike. The rest are small rollups of it.
    """
    net = _net(observations)
    return {"observations": net.drop(RUN, DAY), **turnstile_rollups(net, lookup, periods)}


def _net(reads: DataFrame) -> DataFrame:
    required = [c for c in TURNSTILE_REQUIRED if c in reads.columns]
    return grouped_net_counts(reject_null_rows(reads, required))


def net_observations(reads: DataFrame) -> DataFrame:
    """Complete reads with their net counts."""
    return _net(reads).drop(RUN, DAY)


def turnstile_rollups(
    net: DataFrame, lookup: DataFrame, periods: Sequence[str] = TRANSIT_PERIODS
) -> dict[str, DataFrame]:
    """Daily, monthly and annual tables from net counts, stored or just made."""
    units = settle(daily_totals_all_periods(net, ALL_DAY, periods))
    groups = settle(daily_group_totals(units, lookup, by=("period",)))
    return {
        "daily_subunit": units,
        "daily_complex": groups,
        "monthly_complex": monthly_summary(groups, by=("period",)),
        "annual_complex": annual_summary(groups, by=("period",)),
    }


def annual_by_year(
    annual: DataFrame,
    stations: DataFrame,
    years: Sequence[int],
    key: str = "complex_id",
    fanout: bool = False,
    point: tuple[str, str] | None = ("x", "y"),
) -> DataFrame:
    """Annual figures side by side for the complexes of the latest year.

    Means over all years need every year; so do totals. With `point` the
    centre of the complex's stations is attached.
    """
    counters = ("entries", "exits")
    figures = fanout_join_aggregate(stations, annual, key, fanout, counters)
    measures = [f"mean_daily_{c}" for c in counters] + [f"total_{c}" for c in counters]
    wide = multiway_left_join(figures, years, measures, key)
    for c in counters:
        wide = wide.withColumns(
            {
                f"mean_daily_{c}_all": multi_year_mean([f"mean_daily_{c}_{y}" for y in years]),
                f"total_{c}_all": multi_year_total([f"total_{c}_{y}" for y in years]),
            }
        )
    if point is None:
        return wide
    return wide.join(centroid_of_group(stations, key, *point), key, "left")
