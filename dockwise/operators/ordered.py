"""Looking back one row per key without gathering a hot key in one task.

A `lag` window sorts everything a key owns in a single task, which fails for a
key that owns a third of the table. So every key is cut into runs of a fixed
number of days. The last row of each run, found by a pre-aggregated max, is
carried into the key's next run that holds rows; the `lag` then runs per (key,
run). One plan serves all sizes: nothing is counted, collected or written while
it is built.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: Days of a run. A task holds one key's rows of that many days at most.
RUN_DAYS = 28
RUN = "_run"
_CARRIED = "_carried"


def with_previous(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    values: Sequence[str],
    day: str,
    prefix: str = "previous_",
    run_days: int = RUN_DAYS,
) -> DataFrame:
    """Add `prefix + v` for every v in values: its value on the row before.

    Rows follow `order` with nulls first, then `values`, so that the result
    depends on the data alone. `day` is a date that grows with the first order
    column. Rows leave grouped by (key, _run), `_run` being the number of the
    run of days; callers drop it once they have no use for the grouping.
    """
    line = list(dict.fromkeys([*order, *values]))
    rows = df.withColumn(RUN, F.floor(F.unix_date(day) / run_days).cast("long"))
    both = rows.withColumn(_CARRIED, F.lit(False)).unionByName(
        _carried_rows(rows, key, line), allowMissingColumns=True
    )
    before = F.lag(F.struct(*values)).over(W.partitionBy(key, RUN).orderBy(F.desc(_CARRIED), *line))
    looked_up = both.withColumn("_before", before).filter(~F.col(_CARRIED)).drop(_CARRIED)
    found = {prefix + v: F.col(f"_before.{v}") for v in values}
    return looked_up.withColumns(found).drop("_before")


def _carried_rows(rows: DataFrame, key: str, line: Sequence[str]) -> DataFrame:
    """The last row of each run of a key, placed in the key's next run that holds rows."""
    last = rows.groupBy(key, RUN).agg(F.max(F.struct(*line)).alias("_last"))
    following = F.lead(RUN).over(W.partitionBy(key).orderBy(RUN))
    return (
        last.withColumn(RUN, following)
        .filter(F.col(RUN).isNotNull())
        .select(key, RUN, "_last.*", F.lit(True).alias(_CARRIED))
    )


def with_day(df: DataFrame, name: str, day: Column) -> DataFrame:
    """Attach the day column unless the caller already has it."""
    return df if name in df.columns else df.withColumn(name, day)
