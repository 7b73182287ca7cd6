"""Cleaning of raw feeds: headers, keys, casts and row filters."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Crash reports count from this instant on, slivers end below
# this area in square feet, and more daily trips per dock than this are a typo.
CRASHES_SINCE = "2019-01-01T00:00:00.000"
MIN_TRACT_AREA = 278784
TYPO_LIMIT = 20
TYPO_FACTOR = 10


def normalize_headers(df: DataFrame, snake: bool = True) -> DataFrame:
    """Trim headers; with `snake` also lower them and join words by underscores."""

    def tidy(name: str) -> str:
        return re.sub(" ", "_", name.lower().strip()) if snake else name.strip()

    return df.toDF(*[tidy(c) for c in df.columns])


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def prune_columns(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The listed columns, those of them that exist."""
    return df.select(*[c for c in keep if c in df.columns])


def parse_observed_at(
    df: DataFrame,
    date_col: str = "date",
    time_col: str = "time",
    fmt: str = "MM/dd/yyyy HH:mm:ss",
    name: str = "observed_at",
) -> DataFrame:
    """One zone-less timestamp from a date text and a time text."""
    return df.withColumn(
        name, F.to_timestamp_ntz(F.concat(date_col, F.lit(" "), time_col), F.lit(fmt))
    )


def unit_keys(
    df: DataFrame,
    parts: Sequence[str] = ("controlarea", "remoteunit", "subunit_channel_position"),
    ts_col: str = "observed_at",
) -> DataFrame:
    """`unit_id` from its parts and `id` from unit and second; null if any part is."""
    named = df.withColumn("unit_id", F.concat(*parts))
    stamp = F.translate(F.substring(F.col(ts_col).cast("string"), 1, 19), "- :", "")
    return named.withColumn("id", F.concat("unit_id", stamp))


def trip_duration(
    df: DataFrame,
    start: str = "started_at",
    end: str = "ended_at",
    name: str = "duration_seconds",
) -> DataFrame:
    """Whole seconds from start to end."""
    gap = F.col(end) - F.col(start)
    seconds = (
        F.extract(F.lit("DAY"), gap).cast("long") * 86400
        + F.extract(F.lit("HOUR"), gap).cast("long") * 3600
        + F.extract(F.lit("MINUTE"), gap).cast("long") * 60
        + F.extract(F.lit("SECOND"), gap).cast("long")
    )
    return df.withColumn(name, seconds)


def membership_flags(df: DataFrame, array_col: str, flags: Mapping[str, str]) -> DataFrame:
    """One boolean per value: is it in the list."""
    return df.withColumns(
        {
            name: F.coalesce(F.array_contains(array_col, value), F.lit(False))
            for value, name in flags.items()
        }
    )


def optional_field(df: DataFrame, col: str, dtype: str = "string") -> DataFrame:
    """The column, or nulls where the input has none."""
    return df if col in df.columns else df.withColumn(col, F.lit(None).cast(dtype))


def text_to_number(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Text columns as numbers in place; what is no number becomes null."""
    return df.withColumns({c: F.trim(c).try_cast(t) for c, t in types.items()})


def population_per_cell(
    df: DataFrame, cell_area: float, population: str = "population", area: str = "area"
) -> DataFrame:
    """Add `cell_area` and `pop_per_area`, the people one cell of a tract holds."""
    share = F.try_divide(F.col(population) * F.lit(float(cell_area)), F.col(area))
    return df.withColumns({"cell_area": F.lit(float(cell_area)), "pop_per_area": share})


def fix_capacity_typo(
    df: DataFrame,
    col: str = "trips_per_day_per_dock",
    limit: float = TYPO_LIMIT,
    factor: float = TYPO_FACTOR,
) -> DataFrame:
    """Rates too high to be true come from a capacity that lost a zero."""
    value = F.col(col)
    return df.withColumn(col, F.when(value > limit, value / factor).otherwise(value))


def filter_cyclist_crashes(
    df: DataFrame,
    since: str = CRASHES_SINCE,
    date: str = "crash_date",
    killed: str = "number_of_cyclist_killed",
    injured: str = "number_of_cyclist_injured",
) -> DataFrame:
    """Crashes since an instant, compared as text, that hurt a cyclist."""
    return df.filter((F.col(date) >= since) & ((F.col(killed) > 0) | (F.col(injured) > 0)))


def filter_complete_trips(
    df: DataFrame, cols: Sequence[str] = ("start_station_id", "end_station_id")
) -> DataFrame:
    return df.dropna(subset=list(cols))


def exclude_round_trips(
    df: DataFrame, start: str = "start_station_id", end: str = "end_station_id"
) -> DataFrame:
    return df.filter(F.col(start) != F.col(end))


def filter_month(df: DataFrame, ts_col: str, months: Sequence[int]) -> DataFrame:
    return df.filter(F.month(ts_col).isin(*months))


def filter_slivers(
    df: DataFrame, area_col: str = "area", min_area: float = MIN_TRACT_AREA
) -> DataFrame:
    return df.filter(F.col(area_col) > min_area)


def filter_category(df: DataFrame, col: str, value) -> DataFrame:
    return df.filter(F.col(col) == value)


def reject_null_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows with a null in a required column go; duplicates stay."""
    return df.dropna(subset=list(cols))


def file_date(name: Column) -> Column:
    """Date of the first six digits of a name, as `yymmdd`."""
    digits = F.regexp_extract(name, r"\d{6}", 0)
    # two-digit years from 69 on belong to the last century
    century = F.when(F.substring(digits, 1, 2) >= "69", "19").otherwise("20")
    return F.to_date(F.try_to_timestamp(F.concat(century, digits), F.lit("yyyyMMdd")))


def dated_between(name: Column, start=None, end=None) -> Column:
    """Whether a file name's date lies within [start, end], both inclusive."""
    date = file_date(name)
    inside = date.isNotNull()
    if start is not None:
        inside = inside & (date >= F.lit(start).cast("date"))
    if end is not None:
        inside = inside & (date <= F.lit(end).cast("date"))
    return inside


def filter_files_by_date(files: DataFrame, start=None, end=None, name: str = "name") -> DataFrame:
    """Files whose name holds a `yymmdd` date within [start, end], both inclusive."""
    dated = files.withColumn("file_date", file_date(F.col(name)))
    return dated.filter(dated_between(F.col(name), start, end))


def period_file_range(
    df: DataFrame, first: tuple[int, int], last: tuple[int, int], year="year", month="month"
) -> DataFrame:
    """Rows of the months first..last, given as (year, month)."""
    return df.filter(month_in_range(F.col(year), F.col(month), first, last))


def month_in_range(
    year: Column, month: Column, first: tuple[int, int], last: tuple[int, int]
) -> Column:
    """Prunes directories when year and month are partition columns."""
    after = (year > first[0]) | ((year == first[0]) & (month >= first[1]))
    before = (year < last[0]) | ((year == last[0]) & (month <= last[1]))
    return after & before
