"""Turnstile counters: deltas, service-day totals and period rollups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockwise.functions.calendar import (
    TRANSIT_PERIODS,
    hours_between,
    period_start,
    service_day,
    tag_periods,
    transit_period,
)
from dockwise.operators.joins import left_join_lookup
from dockwise.operators.ordered import RUN, RUN_DAYS, with_day, with_previous

# A delta counts only below this size and within this gap.
DELTA_CAP = 10000
MAX_GAP_HOURS = 24
COUNTERS = ("entries", "exits")
TIES = ("id", "filename")
DAY = "_service_day"


def _previous(df, unit, ts, values, tie, run_days=RUN_DAYS) -> DataFrame:
    dated = df.withColumn(DAY, service_day(ts))
    order = [ts, *[c for c in tie if c in df.columns]]
    return with_previous(dated, unit, order, values, DAY, run_days=run_days)


def counter_delta(
    df: DataFrame,
    unit: str = "unit_id",
    ts: str = "observed_at",
    counters: Sequence[str] = COUNTERS,
    tie: Sequence[str] = TIES,
) -> DataFrame:
    """Add `calculated_net_<counter>`: the counter less its value one read earlier."""
    rows = _previous(df, unit, ts, counters, tie)
    deltas = {f"calculated_net_{c}": F.col(c) - F.col(f"previous_{c}") for c in counters}
    return rows.withColumns(deltas).drop(RUN, DAY, *[f"previous_{c}" for c in counters])


def gap_hours(
    df: DataFrame, unit: str = "unit_id", ts: str = "observed_at", tie: Sequence[str] = TIES
) -> DataFrame:
    """Add `hours_difference`: hours since the unit's read before, exact to the microsecond."""
    rows = _previous(df, unit, ts, [ts], tie)
    gap = hours_between(F.col(f"previous_{ts}"), F.col(ts))
    return rows.withColumn("hours_difference", gap).drop(RUN, DAY, f"previous_{ts}")


def plausible_delta(
    delta: Column, gap: Column, cap: int = DELTA_CAP, max_gap: float = MAX_GAP_HOURS
) -> Column:
    """Size of a delta, or null when it is too big or the gap too long."""
    return F.when((F.abs(delta) < cap) & (gap <= max_gap), F.abs(delta))


def net_counts(
    df: DataFrame,
    unit: str = "unit_id",
    ts: str = "observed_at",
    counters: Sequence[str] = COUNTERS,
    cap: int = DELTA_CAP,
    max_gap: float = MAX_GAP_HOURS,
    tie: Sequence[str] = TIES,
    run_days: int = RUN_DAYS,
    dedupe: bool = False,
) -> DataFrame:
    """Add `net_<counter>` and `hours_difference`, keeping every row.

    With `dedupe` a read that repeats unit, time and counters is left out first; any one
    of the repeats stays.
    """
    rows = df.dropDuplicates([unit, ts, *counters]) if dedupe else df
    return grouped_net_counts(rows, unit, ts, counters, cap, max_gap, tie, run_days).drop(RUN, DAY)


def grouped_net_counts(
    df: DataFrame,
    unit: str = "unit_id",
    ts: str = "observed_at",
    counters: Sequence[str] = COUNTERS,
    cap: int = DELTA_CAP,
    max_gap: float = MAX_GAP_HOURS,
    tie: Sequence[str] = TIES,
    run_days: int = RUN_DAYS,
) -> DataFrame:
    """`net_counts` with the columns its rows are grouped by, which daily totals reuse."""
    rows = _previous(df, unit, ts, [ts, *counters], tie, run_days)
    gap = hours_between(F.col(f"previous_{ts}"), F.col(ts))
    rows = rows.withColumn("hours_difference", gap)
    nets = {
        f"net_{c}": plausible_delta(
            F.col(c) - F.col(f"previous_{c}"), F.col("hours_difference"), cap, max_gap
        ).cast("long")
        for c in counters
    }
    return rows.withColumns(nets).drop(*[f"previous_{c}" for c in (ts, *counters)])


def filter_regular_interval(
    df: DataFrame, lo: float = 3, hi: float = 5, gap: str = "hours_difference"
) -> DataFrame:
    """Reads that close an interval of the usual four hours."""
    return df.filter(is_regular_interval(lo, hi, gap))


def is_regular_interval(lo: float = 3, hi: float = 5, gap: str = "hours_difference") -> Column:
    return (F.col(gap) > lo) & (F.col(gap) < hi)


def _totals(net: DataFrame, keys: list, remote: str, counters: Sequence[str]) -> DataFrame:
    """Sums per key and day. A unit has one remote as a rule, so it is grouped by it first:
    plain sums aggregate by hash, and the smallest remote is taken of the few rows left."""
    # the run follows from unit and day; naming it keeps the grouping the rows already have
    keys = [*keys, *[c for c in (RUN,) if c in net.columns], DAY]
    sums = [F.sum(f"net_{c}").alias(c) for c in counters]
    by_remote = net.groupBy(*keys, F.col(remote).alias("_remote")).agg(*sums)
    totals = by_remote.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in counters], F.min("_remote").alias("remoteunit")
    )
    return totals.drop(RUN).withColumnRenamed(DAY, "date")


def daily_unit_totals(
    net: DataFrame,
    unit: str = "unit_id",
    ts: str = "observed_at",
    remote: str = "remoteunit",
    counters: Sequence[str] = COUNTERS,
    shift_hours: int = 2,
) -> DataFrame:
    """Entries and exits per unit and service day."""
    if shift_hours != 2 or DAY not in net.columns:
        net = net.withColumn(DAY, service_day(ts, shift_hours)).drop(RUN)
    return _totals(net, [unit], remote, counters)


def daily_period_unit_totals(
    net: DataFrame,
    periods: Sequence[str] = TRANSIT_PERIODS,
    unit: str = "unit_id",
    ts: str = "observed_at",
    remote: str = "remoteunit",
    counters: Sequence[str] = COUNTERS,
) -> DataFrame:
    """The same per period, all periods in one pass over the regular intervals."""
    net = with_day(filter_regular_interval(net), DAY, service_day(ts))
    starts = period_start(net, ts)
    tagged = tag_periods(starts, {p: transit_period(p) for p in periods})
    return _totals(tagged, ["period", unit], remote, counters)


def daily_totals_all_periods(
    net: DataFrame,
    whole_day: str = "all",
    periods: Sequence[str] = TRANSIT_PERIODS,
    unit: str = "unit_id",
    ts: str = "observed_at",
    remote: str = "remoteunit",
    counters: Sequence[str] = COUNTERS,
) -> DataFrame:
    """Whole-day and period totals together, from one pass over the net counts."""
    starts = period_start(with_day(net, DAY, service_day(ts)), ts)
    regular = is_regular_interval()
    predicates = {whole_day: F.lit(True)}
    predicates |= {p: regular & transit_period(p) for p in periods}
    return _totals(tag_periods(starts, predicates), ["period", unit], remote, counters)


def daily_group_totals(
    daily: DataFrame,
    lookup: DataFrame,
    remote: str = "remote",
    group: str = "complex_id",
    counters: Sequence[str] = COUNTERS,
    by: Sequence[str] = (),
) -> DataFrame:
    """Entries and exits per complex and day; a remote without one stands for itself."""
    placed = left_join_lookup(daily, lookup, "remoteunit", remote, group)
    return placed.groupBy(*by, group, "date").agg(*[F.sum(c).alias(c) for c in counters])


def daily_period_group_totals(daily: DataFrame, lookup: DataFrame, **kwargs) -> DataFrame:
    """Entries and exits per period, complex and day."""
    return daily_group_totals(daily, lookup, by=("period",), **kwargs)


def _summary(daily: DataFrame, keys: list, counters: Sequence[str], *more: Column) -> DataFrame:
    measures = []
    for c in counters:
        measures += [
            F.avg(c).cast("long").alias(f"mean_daily_{c}"),
            F.sum(c).alias(f"total_{c}"),
        ]
    return daily.groupBy(*keys).agg(*measures, *more)


def having_min_days(df: DataFrame, n: int = 10, days: str = "n_days") -> DataFrame:
    """Groups with more than n daily rows."""
    return df.filter(F.col(days) > n)


def monthly_summary(
    daily: DataFrame,
    key: str = "complex_id",
    min_days: int = 10,
    date: str = "date",
    counters: Sequence[str] = COUNTERS,
    by: Sequence[str] = (),
) -> DataFrame:
    """Mean (cut to whole) and total per complex and month with enough days."""
    keys = [*by, key, F.year(date).alias("year"), F.month(date).alias("month")]
    months = _summary(daily, keys, counters, F.count(F.lit(1)).alias("n_days"))
    return having_min_days(months, min_days).drop("n_days")


def annual_summary(
    daily: DataFrame,
    key: str = "complex_id",
    date: str = "date",
    counters: Sequence[str] = COUNTERS,
    by: Sequence[str] = (),
) -> DataFrame:
    """Mean (cut to whole) and total per complex and year."""
    return _summary(daily, [*by, key, F.year(date).alias("year")], counters)


def distinct_remotes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct combinations of the given columns."""
    return df.select(*cols).distinct()


def ordered_summary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A summary in reading order."""
    return df.orderBy(*cols)


def sort_observations(df: DataFrame, cols: Sequence[str] = ("unit_id", "observed_at")) -> DataFrame:
    """Physical order inside the partitions, for compact files and cheap scans."""
    return df.sortWithinPartitions(*cols)
