"""Trips: one layout from two, station tables and yearly rollups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockwise.operators.clean import (
    exclude_round_trips,
    filter_complete_trips,
    prune_columns,
    trip_duration,
)

# The shared trip layout and the older one's names for it.
TRIP_COLUMNS = (
    "start_station_id",
    "start_station_name",
    "end_station_id",
    "end_station_name",
    "start_lng",
    "start_lat",
    "end_lng",
    "end_lat",
    "rideable_type",
    "started_at",
    "duration_seconds",
    "ended_at",
    "member_casual",
)
OLD_NAMES = {
    "start station latitude": "start_lat",
    "start station longitude": "start_lng",
    "end station latitude": "end_lat",
    "end station longitude": "end_lng",
    "start station name": "start_station_name",
    "end station name": "end_station_name",
    "start station id": "start_station_id",
    "end station id": "end_station_id",
}
# Ids changed in February 2021, a year counted as 365 days.
ERA_SWITCH = (2021, 2)
FIXED_DAYS = {2021: 365}
STAMP = "yyyy-MM-dd HH:mm:ss"


def _stamp(text: Column) -> Column:
    return F.to_timestamp_ntz(text, F.lit(STAMP))


def _cut(text: str) -> Column:
    """The older layout writes a five-character fraction behind the seconds."""
    return F.expr(f"left(`{text}`, length(`{text}`) - 5)")


def _typed(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The shared layout from texts under the shared names."""
    df = df.withColumns({c: _stamp(F.col(c)) for c in ("started_at", "ended_at")})
    numbers = {c: F.col(c).try_cast("double") for c in df.columns if c.endswith(("_lat", "_lng"))}
    df = trip_duration(df.withColumns(numbers))
    for missing in ("rideable_type", "member_casual"):
        if missing not in df.columns:
            df = df.withColumn(missing, F.lit(None).cast("string"))
    return prune_columns(df, [*TRIP_COLUMNS, *keep])


def _one_layout(df: DataFrame) -> DataFrame:
    if "starttime" in df.columns:
        old = {"starttime": "started_at", "stoptime": "ended_at"}
        df = df.withColumns({new: _cut(name) for name, new in old.items()}).withColumnsRenamed(OLD_NAMES)
    return _typed(df)


def harmonize_mixed(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Trips whose rows hold either layout, as texts under both sets of names; one pass.

    Rows with a `starttime` are of the older layout. Columns in `keep` pass.
    """
    shared = {"started_at": _cut("starttime"), "ended_at": _cut("stoptime")}
    shared |= {new: F.col(f"`{old}`") for old, new in OLD_NAMES.items()}
    older = F.col("starttime").isNotNull()
    both = df.withColumns({new: F.when(older, old).otherwise(F.col(new)) for new, old in shared.items()})
    return _typed(both, keep)


def harmonize_trips(*dfs: DataFrame) -> DataFrame:
    """Old and new trip tables as one table of the shared layout."""
    first, *rest = [_one_layout(df) for df in dfs]
    for df in rest:
        first = first.unionByName(df, allowMissingColumns=True)
    return first


def first_non_null_per_key(
    df: DataFrame, key: str, cols: Sequence[str], order: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """Per key and column the first non-null value in the given order.

    Rows that agree in all but the first order column are one row first, by a hash
    aggregate; what is left is as many rows as there are different values.
    """
    line = F.struct(*order) if len(order) > 1 else F.col(order[0])
    firsts = [
        F.min_by(F.col(c), F.when(F.col(c).isNotNull(), line)).alias(c) for c in cols
    ]
    first, *ties = order
    alike = list(dict.fromkeys([*by, key, *ties, *[c for c in cols if c != first]]))
    known = df.filter(F.col(key).isNotNull()).groupBy(*alike).agg(F.min(first).alias(first))
    return known.groupBy(*by, key).agg(*firsts)


def union_distinct_stations(
    starts: DataFrame, ends: DataFrame, key: str = "station_id"
) -> DataFrame:
    """Start stations, then end stations not among them."""
    ranked = starts.withColumn("_rank", F.lit(0)).unionByName(ends.withColumn("_rank", F.lit(1)))
    return _best_ranked(ranked, key)


def _best_ranked(ranked: DataFrame, key: str) -> DataFrame:
    rest = [c for c in ranked.columns if c not in (key, "_rank")]
    best = ranked.groupBy(key).agg(F.min_by(F.struct(*rest), "_rank").alias("_row"))
    return best.select(key, "_row.*")


def stations_of_trips(trips: DataFrame) -> DataFrame:
    """Station table of a trip table: id, name and position as first seen.

    What the trips that begin at a station say goes before what those that end
    there say. Both come from one pass over the trips.
    """
    cols = ["station_name", "lng", "lat"]

    def side(rank: int, name: str) -> Column:
        return F.struct(
            F.lit(rank).alias("_rank"),
            F.col(f"{name}_station_id").alias("station_id"),
            F.col(f"{name}_station_name").alias("station_name"),
            F.col(f"{name}_lng").alias("lng"),
            F.col(f"{name}_lat").alias("lat"),
        )

    both = F.explode(F.array(side(0, "start"), side(1, "end"))).alias("_side")
    seen = trips.select("started_at", both).select("started_at", "_side.*")
    firsts = first_non_null_per_key(seen, "station_id", cols, ["started_at", *cols], ["_rank"])
    return _best_ranked(firsts, "station_id")


def complete_trips(trips: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Trips with both stations, without the station attributes."""
    kept = filter_complete_trips(trips)
    return kept.select(
        "rideable_type",
        "started_at",
        "duration_seconds",
        "ended_at",
        "member_casual",
        "start_station_id",
        "end_station_id",
        *keep,
    )


def trip_ends_by_station(
    trips: DataFrame,
    by: Mapping[str, Column] | None = None,
    start: str = "start_station_id",
    end: str = "end_station_id",
) -> DataFrame:
    """Trips begun and trips ended per station, in one pass, round trips left out."""
    by = dict(by or {})
    moving = exclude_round_trips(trips, start, end).withColumns(by) if by else (
        exclude_round_trips(trips, start, end)
    )
    side = F.explode(
        F.array(
            F.struct(F.col(start).alias("id"), F.lit(True).alias("is_start")),
            F.struct(F.col(end).alias("id"), F.lit(False).alias("is_start")),
        )
    )
    ends = moving.select(*by, side.alias("_side")).select(*by, "_side.*")
    return ends.groupBy(*by, "id").agg(
        F.count_if(F.col("is_start")).alias("start_trips"),
        F.count_if(~F.col("is_start")).alias("end_trips"),
    )


def trip_starts(trips: DataFrame, start="start_station_id", end="end_station_id") -> DataFrame:
    """Trips begun per station."""
    counts = exclude_round_trips(trips, start, end).groupBy(start)
    return counts.agg(F.count(F.lit(1)).alias("start_trips")).withColumnRenamed(start, "station_id")


def trip_ends(trips: DataFrame, start="start_station_id", end="end_station_id") -> DataFrame:
    """Trips ended per station."""
    counts = exclude_round_trips(trips, start, end).groupBy(end)
    return counts.agg(F.count(F.lit(1)).alias("end_trips")).withColumnRenamed(end, "station_id")


def active_days(trips: DataFrame, ts_col: str = "started_at", by: Sequence[str] = ()) -> DataFrame:
    """Number of different dates."""
    return trips.groupBy(*by).agg(F.countDistinct(F.to_date(ts_col)).alias("days"))


def join_starts_ends(
    stations: DataFrame,
    starts: DataFrame,
    ends: DataFrame,
    on: str = "station_id",
    fill_zero: bool = False,
) -> DataFrame:
    """Starts plus ends per station; null when either is missing unless filled."""
    joined = stations.join(starts, on, "left").join(ends, on, "left")
    start, end = F.col("start_trips"), F.col("end_trips")
    if fill_zero:
        start, end = F.coalesce(start, F.lit(0)), F.coalesce(end, F.lit(0))
    return joined.withColumn("total_trips", start + end).drop("start_trips", "end_trips")


def id_era(ts: Column, switch: tuple[int, int] = ERA_SWITCH) -> Column:
    """Which station id a trip carries: `legacy` before the switch, then `modern`."""
    month = F.year(ts) * 12 + F.month(ts)
    return F.when(month < switch[0] * 12 + switch[1], "legacy").otherwise("modern")


def station_ids(
    stations: DataFrame, legacy: str = "legacy_id", modern: str = "short_name"
) -> DataFrame:
    """Stations once per id era: (era, id, station_id)."""
    pair = F.array(
        F.struct(F.lit("legacy").alias("era"), F.col(legacy).alias("id")),
        F.struct(F.lit("modern").alias("era"), F.col(modern).alias("id")),
    )
    return stations.select("station_id", F.explode(pair).alias("_id")).select(
        "station_id", "_id.era", "_id.id"
    )


def join_station_by_id_era(
    trips: DataFrame,
    stations: DataFrame,
    ts_col: str = "started_at",
    id_col: str = "start_station_id",
    switch: tuple[int, int] = ERA_SWITCH,
    legacy: str = "legacy_id",
    modern: str = "short_name",
) -> DataFrame:
    """Attach the lasting station id, null where the id of the trip's era is unknown."""
    ids = station_ids(stations, legacy, modern).withColumnRenamed("id", "_id")
    tagged = trips.withColumn("id_era", id_era(F.col(ts_col), switch))
    match = (F.col("id_era") == F.col("era")) & (F.col(id_col) == F.col("_id"))
    return tagged.join(ids, match, "left").drop("era", "_id")


def _rates(df: DataFrame) -> DataFrame:
    total = F.col("total_trips").cast("double")
    docks, days = F.col("capacity").cast("double"), F.col("days").cast("double")
    return df.withColumns(
        {
            "trips_per_dock": F.try_divide(total, docks),
            "trips_per_day": F.try_divide(total, days),
            "trips_per_day_per_dock": F.try_divide(total, days * docks),
        }
    )


def trips_summary_year(
    trips: DataFrame,
    stations: DataFrame,
    years: Sequence[int],
    ts_col: str = "started_at",
    days: Mapping[int, int] | None = None,
    switch: tuple[int, int] = ERA_SWITCH,
    legacy: str = "legacy_id",
    modern: str = "short_name",
) -> DataFrame:
    """Trips and rates per year and station, all years in one pass over the trips.

    A total is null when the station lacks starts or ends in any id era the
    year has. The switch year counts `days[year]` days, other years the dates
    that occur.
    """
    days = FIXED_DAYS if days is None else days
    year = F.year(ts_col)
    # the plain bounds reach the scan, the list of years trims what is between
    since = F.lit(f"{min(years)}-01-01").cast("timestamp_ntz")
    until = F.lit(f"{max(years) + 1}-01-01").cast("timestamp_ntz")
    wanted = trips.filter((F.col(ts_col) >= since) & (F.col(ts_col) < until))
    wanted = wanted.filter(year.isin(*years))
    counts = trip_ends_by_station(
        wanted, {"year": year, "era": id_era(F.col(ts_col), switch)}
    ).filter("start_trips > 0 AND end_trips > 0")
    per_station = (
        counts.join(station_ids(stations, legacy, modern), ["era", "id"])
        .groupBy("year", "station_id")
        .agg(
            F.sum(F.col("start_trips") + F.col("end_trips")).alias("total_trips"),
            F.count(F.lit(1)).alias("_eras"),
        )
    )
    eras = F.when(F.col("year") == switch[0], 2 if switch[1] > 1 else 1).otherwise(1)
    per_station = per_station.filter(F.col("_eras") == eras).drop("_eras")
    seen = active_days(wanted.select(year.alias("year"), ts_col), ts_col, ["year"])
    for fixed, count in days.items():
        seen = seen.withColumn(
            "days", F.when(F.col("year") == fixed, F.lit(count).cast("long")).otherwise(F.col("days"))
        )
    grid = stations.select("station_id", "capacity").withColumn(
        "year", F.explode(F.array(*[F.lit(y) for y in years]))
    )
    joined = grid.join(per_station, ["year", "station_id"], "left").join(seen, "year", "left")
    return _rates(joined).drop("days")


def trips_summary_all(yearly: DataFrame, stations: DataFrame) -> DataFrame:
    """All years per station: trips summed, rates averaged, trips per dock cut to whole."""
    totals = yearly.groupBy("station_id").agg(
        F.sum("total_trips").alias("total_trips"),
        F.avg("trips_per_day").alias("trips_per_day"),
        F.avg("trips_per_day_per_dock").alias("trips_per_day_per_dock"),
    )
    joined = stations.join(totals, "station_id", "left")
    whole = F.when(F.col("capacity") != 0, F.expr("total_trips div capacity"))
    return joined.withColumn("trips_per_dock", whole)
