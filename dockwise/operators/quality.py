"""Table constraints as DataFrame checks: each returns what breaks the rule."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def require_none(violations: DataFrame, rule: str) -> None:
    """Fails with the first rows that break a rule; a table without any passes."""
    found = violations.limit(5).collect()
    if found:
        raise ValueError(f"{rule}: {', '.join(str(r.asDict()) for r in found)}")


def check_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per required column with its number of nulls."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return counted.unpivot([], list(cols), "column", "nulls")


def check_domain(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Number of rows, and of rows outside the allowed values (nulls pass)."""
    outside = F.count_if(~F.col(col).isin(*values)).alias("violations")
    return df.agg(F.count(F.lit(1)).alias("total"), outside)


def check_unique(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def check_foreign_key(df: DataFrame, ref: DataFrame, on: str, ref_key: str) -> DataFrame:
    """Key values that the referenced table lacks, with their number of rows.

    Counted per value before the join, so a hot value travels as one row.
    """
    used = df.filter(F.col(on).isNotNull()).groupBy(on).agg(F.count(F.lit(1)).alias("n"))
    known = ref.select(F.col(ref_key).alias(on))
    return used.join(known, on, "left_anti")


def check_row_limit(df: DataFrame, limit: int) -> DataFrame:
    """Whether the table is exactly as long as the fetch limit, hence likely cut."""
    rows = F.count(F.lit(1))
    return df.agg(rows.alias("row_count"), (rows == limit).alias("limit_reached"))
