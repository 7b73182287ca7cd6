"""Calendar columns: service days, period starts and the peak periods."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Peak hours and weekdays of the two feeds.
TRANSIT_MORNING_HOURS = (4, 5, 6, 7)
TRANSIT_EVENING_HOURS = (14, 15, 16, 17)
TRANSIT_WORKDAYS = (1, 2, 3, 4, 5)  # Sunday is 0
STATION_MORNING_HOURS = (6, 7, 8, 9)
STATION_EVENING_HOURS = (16, 17, 18, 19)
STATION_WORKDAYS = (0, 1, 2, 3, 4)  # Monday is 0
TRANSIT_PERIODS = ("morning_peak", "evening_peak", "peak", "offpeak")
STATION_PERIODS = ("all", "morning_peak", "evening_peak", "peak", "offpeak")


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def hours_before(ts: Column | str, hours: int) -> Column:
    return _column(ts) - F.make_dt_interval(hours=F.lit(hours))


def service_day(ts: Column | str, shift_hours: int = 2) -> Column:
    """The date a read belongs to when the day starts `shift_hours` past midnight."""
    return F.to_date(hours_before(ts, shift_hours))


def period_start(df: DataFrame, ts_col: str = "observed_at", shift_hours: int = 4) -> DataFrame:
    """Hour at which the interval ending at `ts_col` began, and weekday of its end."""
    return df.withColumns(
        {
            "period_start_hour": F.hour(hours_before(ts_col, shift_hours)),
            "weekday": F.dayofweek(ts_col) - 1,
        }
    )


def _periods(hour: Column, workday: Column, morning: tuple, evening: tuple) -> dict[str, Column]:
    rush = morning + evening
    return {
        "morning_peak": hour.isin(*morning) & workday,
        "evening_peak": hour.isin(*evening) & workday,
        "peak": hour.isin(*rush) & workday,
        "offpeak": ~hour.isin(*rush) | ~workday,
    }


def transit_period(
    name: str, hour: Column | str = "period_start_hour", weekday: Column | str = "weekday"
) -> Column:
    """Predicate of one turnstile period."""
    workday = _column(weekday).isin(*TRANSIT_WORKDAYS)
    return _periods(_column(hour), workday, TRANSIT_MORNING_HOURS, TRANSIT_EVENING_HOURS)[name]


def station_period(
    name: str,
    hour: Column | str = "reported_hour",
    weekday: Column | str = "reported_weekday",
    stale: Column | str = "stale",
) -> Column:
    """Predicate of one station-status period; `all` keeps stale rows, the rest do not."""
    if name == "all":
        return F.lit(True)
    workday = _column(weekday).isin(*STATION_WORKDAYS)
    chosen = _periods(_column(hour), workday, STATION_MORNING_HOURS, STATION_EVENING_HOURS)[name]
    return chosen & (_column(stale) == 0)


def tag_periods(df: DataFrame, predicates: dict[str, Column], name: str = "period") -> DataFrame:
    """One row per period a row belongs to, so that all periods share one aggregation."""
    tags = F.array_compact(F.array(*[F.when(p, F.lit(n)) for n, p in predicates.items()]))
    return df.withColumn(name, F.explode(tags))


def calendar_parts(df: DataFrame, ts_col: str, prefix: str) -> DataFrame:
    """Date, time and the integer parts of a timestamp, Monday being weekday 0."""
    ts = F.col(ts_col)
    return df.withColumns(
        {
            f"{prefix}_datetime": ts,
            f"{prefix}_date": F.to_date(ts),
            f"{prefix}_year": F.year(ts),
            f"{prefix}_month": F.month(ts),
            f"{prefix}_day": F.dayofmonth(ts),
            f"{prefix}_time": F.substring(ts.cast("string"), 12, 8),
            f"{prefix}_hour": F.hour(ts),
            f"{prefix}_minute": F.minute(ts),
            f"{prefix}_second": F.second(ts),
            f"{prefix}_weekday": F.weekday(ts),
        }
    )


def micros_between(start: Column, end: Column) -> Column:
    """Whole microseconds from start to end, with or without a zone."""
    gap = end - start
    return (
        F.extract(F.lit("DAY"), gap).cast("long") * 86_400_000_000
        + F.extract(F.lit("HOUR"), gap).cast("long") * 3_600_000_000
        + F.extract(F.lit("MINUTE"), gap).cast("long") * 60_000_000
        + (F.extract(F.lit("SECOND"), gap) * 1_000_000).cast("long")
    )


def hours_between(start: Column, end: Column) -> Column:
    return micros_between(start, end) / F.lit(3.6e9)
