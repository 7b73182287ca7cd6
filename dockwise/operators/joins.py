"""Joins of facts with small and large dimension tables.

No join carries a broadcast hint: the planner broadcasts a side only when its
measured size stays under `spark.sql.autoBroadcastJoinThreshold`, and beyond
that uses a shuffled join whose skewed partitions adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def left_join_lookup(
    df: DataFrame, lookup: DataFrame, on: str, remote: str = "remote", group: str = "complex_id"
) -> DataFrame:
    """Attach the group of `on`; unmatched or blank groups fall back to `on` itself."""
    pairs = lookup.select(F.col(remote).alias("_remote"), F.col(group).alias("_group")).distinct()
    joined = df.join(pairs, F.col(on) == F.col("_remote"), "left")
    return joined.withColumn(group, F.coalesce("_group", on)).drop("_remote", "_group")


def semi_join_in(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key is in the other table."""
    return df.join(keys.select(on), on, "left_semi")


def anti_join_new(df: DataFrame, existing: DataFrame, on: str) -> DataFrame:
    """Rows whose key the existing table does not hold yet."""
    return df.join(existing.select(on), on, "left_anti")


def update_from_subquery(
    df: DataFrame, values: DataFrame, on: str, cols: Sequence[str]
) -> DataFrame:
    """Columns replaced by the matching row's values, null where nothing matches."""
    picked = values.groupBy(on).agg(*[F.min(c).alias(f"_new_{c}") for c in cols])
    joined = df.join(picked, on, "left")
    replaced = joined.withColumns({c: F.col(f"_new_{c}") for c in cols})
    return replaced.drop(*[f"_new_{c}" for c in cols])


def cross_join_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Every column of a one-row table on every row, as one scalar subquery.

    A table of more than one row fails the job instead of multiplying rows.
    """
    held = df.withColumn("_one", one_row.select(F.struct(*one_row.columns)).scalar())
    return held.withColumns({c: F.col(f"_one.{c}") for c in one_row.columns}).drop("_one")


def multi_year_mean(cols: Sequence[Column | str]) -> Column:
    """Sum of the years over their number; null when any year is missing."""
    columns = [F.col(c) if isinstance(c, str) else c for c in cols]
    return reduce(lambda a, b: a + b, columns) / len(columns)


def multi_year_total(cols: Sequence[Column | str]) -> Column:
    """Sum of the years; null when any year is missing."""
    columns = [F.col(c) if isinstance(c, str) else c for c in cols]
    return reduce(lambda a, b: a + b, columns)


def fanout_join_aggregate(
    stations: DataFrame,
    annual: DataFrame,
    key: str = "complex_id",
    fanout: bool = False,
    counters: Sequence[str] = ("entries", "exits"),
) -> DataFrame:
    """Annual figures of the groups that have stations.

    With `fanout` the totals count once per station of the group, as a plain
    join would have them; the rows themselves are never multiplied.
    """
    per_group = stations.groupBy(key).agg(F.count(F.lit(1)).alias("_stations"))
    measures = []
    for c in counters:
        measures += [
            F.avg(f"mean_daily_{c}").alias(f"mean_daily_{c}"),
            F.sum(f"total_{c}").alias(f"total_{c}"),
        ]
    figures = annual.groupBy(key, "year").agg(*measures)
    joined = figures.join(per_group, key)
    if fanout:
        joined = joined.withColumns(
            {f"total_{c}": F.col(f"total_{c}") * F.col("_stations") for c in counters}
        )
    return joined.drop("_stations")


def multiway_left_join(
    annual: DataFrame, years: Sequence[int], measures: Sequence[str], key: str = "complex_id"
) -> DataFrame:
    """One row per group of the latest year, one column per measure and year.

    `annual` holds one row per group and year. Written as one aggregation
    instead of a join per year.
    """
    latest = max(years)
    picks = [
        F.max(F.when(F.col("year") == y, F.col(m))).alias(f"{m}_{y}")
        for m in measures
        for y in years
    ]
    wide = (
        annual.filter(F.col("year").isin(*years))
        .groupBy(key)
        .agg(F.max(F.col("year") == latest).alias("_latest"), *picks)
    )
    return wide.filter("_latest").drop("_latest")


def centroid_of_group(points: DataFrame, key: str, x: str = "x", y: str = "y") -> DataFrame:
    """Centre of the points of each group."""
    return points.groupBy(key).agg(F.avg(x).alias(x), F.avg(y).alias(y))


def inner_join_station(
    status: DataFrame, station: DataFrame, on: str = "station_id", cols: Sequence[str] | None = None
) -> DataFrame:
    """Status rows of known stations, with the station's columns."""
    side = station if cols is None else station.select(on, *cols)
    return status.join(side, on)


def join_summary_geometry(
    summary: DataFrame, station: DataFrame, on: str = "station_id", geometry=("x", "y")
) -> DataFrame:
    """All periods of a summary with the station's point, joined once."""
    return summary.join(station.select(on, *geometry), on)


def union_years(*tables: DataFrame) -> DataFrame:
    """Yearly tables one after the other, duplicates kept."""
    return reduce(lambda a, b: a.unionByName(b), tables)
