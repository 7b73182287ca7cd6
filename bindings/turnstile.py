"""Turnstile operators on events, orders, customer and supplier."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.registry import bind, lookup, nation_days, observations, sql, stops, table
from dockwise.functions.calendar import (
    TRANSIT_PERIODS,
    period_start,
    service_day,
    tag_periods,
    transit_period,
)
from dockwise.operators import counters as c
from dockwise.operators import joins as j
from dockwise.operators.clean import reject_null_rows
from dockwise.plans.turnstile import annual_by_year, turnstile_tables


def net(spark, sf):
    return c.net_counts(observations(spark, sf))


@bind(
    "counter_delta",
    sql(
        """
        SELECT id, unit_id, entries - lag(entries) OVER w AS calculated_net_entries,
               exits - lag(exits) OVER w AS calculated_net_exits
        FROM obs WINDOW w AS (PARTITION BY unit_id ORDER BY observed_at, id)
        """
    ),
)
def counter_delta(spark, sf):
    rows = c.counter_delta(observations(spark, sf))
    return rows.select("id", "unit_id", "calculated_net_entries", "calculated_net_exits")


@bind("gap_hours", sql("SELECT id, unit_id, observed_at, hours_difference FROM net"))
def gap_hours(spark, sf):
    rows = c.gap_hours(observations(spark, sf))
    return rows.select("id", "unit_id", "observed_at", "hours_difference")


@bind(
    "net_counts",
    sql(
        """
        SELECT id, unit_id, observed_at, entries, exits, net_entries, net_exits, hours_difference
        FROM net
        """
    ),
)
def net_counts(spark, sf):
    return net(spark, sf).drop("remoteunit")


@bind(
    "plausible_delta",
    sql(
        """
        SELECT id, CASE WHEN abs(de) < 5000 AND gap <= 12 THEN abs(de) END AS delta FROM (
            SELECT id, entries - lag(entries) OVER w AS de,
                   (epoch_us(observed_at) - epoch_us(lag(observed_at) OVER w)) / 3.6e9 AS gap
            FROM obs WINDOW w AS (PARTITION BY unit_id ORDER BY observed_at, id))
        """
    ),
)
def plausible_delta(spark, sf):
    rows = c.gap_hours(c.counter_delta(observations(spark, sf)))
    delta = c.plausible_delta(
        F.col("calculated_net_entries"), F.col("hours_difference"), cap=5000, max_gap=12
    )
    return rows.select("id", delta.alias("delta"))


@bind(
    "filter_regular_interval",
    sql(
        """
        SELECT id, hours_difference, net_entries FROM net
        WHERE hours_difference > 3 AND hours_difference < 5
        """
    ),
)
def filter_regular_interval(spark, sf):
    return c.filter_regular_interval(net(spark, sf)).select("id", "hours_difference", "net_entries")


@bind(
    "period_start",
    """
    SELECT event_id, CAST(hour(ts - INTERVAL 4 HOURS) AS INTEGER) AS period_start_hour,
           CAST(dayofweek(ts) AS INTEGER) AS weekday
    FROM events
    """,
)
def start_of_period(spark, sf):
    rows = period_start(table(spark, sf, "events"), "ts")
    return rows.select("event_id", "period_start_hour", "weekday")


@bind(
    "service_day",
    "SELECT event_id, CAST(ts - INTERVAL 2 HOURS AS DATE) AS service_day FROM events",
)
def day_of_service(spark, sf):
    return table(spark, sf, "events").select("event_id", service_day("ts").alias("service_day"))


@bind("transit_period", sql("SELECT period, id FROM period_starts"))
def periods_of_transit(spark, sf):
    rows = period_start(c.filter_regular_interval(net(spark, sf)))
    tagged = tag_periods(rows, {p: transit_period(p) for p in TRANSIT_PERIODS})
    return tagged.select("period", "id")


@bind("daily_unit_totals", sql("SELECT * FROM daily"))
def daily_unit_totals(spark, sf):
    return c.daily_unit_totals(net(spark, sf))


@bind("daily_period_unit_totals", sql("SELECT * FROM daily_period"))
def daily_period_unit_totals(spark, sf):
    return c.daily_period_unit_totals(net(spark, sf))


GROUP_TOTALS = """
    SELECT {by} coalesce(complex_id, remoteunit) AS complex_id, date,
           CAST(sum(entries) AS BIGINT) AS entries, CAST(sum(exits) AS BIGINT) AS exits
    FROM {daily} LEFT JOIN (SELECT DISTINCT remote, complex_id FROM lookup) ON remoteunit = remote
    GROUP BY ALL
"""


@bind("daily_group_totals", sql(GROUP_TOTALS.format(by="", daily="daily")))
def daily_group_totals(spark, sf):
    return c.daily_group_totals(c.daily_unit_totals(net(spark, sf)), lookup(spark, sf))


@bind(
    "daily_period_group_totals", sql(GROUP_TOTALS.format(by="period,", daily="daily_period"))
)
def daily_period_group_totals(spark, sf):
    daily = c.daily_period_unit_totals(net(spark, sf))
    return c.daily_period_group_totals(daily, lookup(spark, sf))


@bind(
    "left_join_lookup",
    sql(
        """
        SELECT id, remoteunit, coalesce(complex_id, remoteunit) AS complex_id
        FROM obs LEFT JOIN (
            SELECT DISTINCT remote, complex_id FROM lookup
            WHERE remote IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_acctbal > 0)
        ) ON remoteunit = remote
        """
    ),
)
def left_join_lookup(spark, sf):
    """A lookup that lacks some remotes: their reads stay, under their own name."""
    reads = observations(spark, sf).select("id", "remoteunit")
    return j.left_join_lookup(reads, lookup(spark, sf, "c_acctbal > 0"), "remoteunit")


@bind("distinct_remotes", "SELECT DISTINCT c_nationkey, c_mktsegment FROM customer")
def distinct_remotes(spark, sf):
    return c.distinct_remotes(table(spark, sf, "customer"), ["c_nationkey", "c_mktsegment"])


MONTHS = """
    SELECT complex_id, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
           CAST(trunc(avg(entries)) AS BIGINT) AS mean_daily_entries,
           CAST(sum(entries) AS BIGINT) AS total_entries,
           CAST(trunc(avg(exits)) AS BIGINT) AS mean_daily_exits,
           CAST(sum(exits) AS BIGINT) AS total_exits
    FROM nation_days GROUP BY ALL
"""


@bind("monthly_summary", sql(MONTHS + " HAVING count(*) > 10"))
def monthly_summary(spark, sf):
    return c.monthly_summary(nation_days(spark, sf))


@bind(
    "having_min_days",
    sql(
        """
        SELECT complex_id, CAST(year(date) AS INTEGER) AS year, count(*) AS n_days
        FROM nation_days GROUP BY ALL HAVING count(*) > 60
        """
    ),
)
def having_min_days(spark, sf):
    days = nation_days(spark, sf).groupBy("complex_id", F.year("date").alias("year"))
    return c.having_min_days(days.agg(F.count(F.lit(1)).alias("n_days")), 60)


@bind("annual_summary", sql("SELECT * FROM annual"))
def annual_summary(spark, sf):
    return c.annual_summary(nation_days(spark, sf))


@bind("ordered_summary", sql(MONTHS + " ORDER BY complex_id, year, month"))
def ordered_summary(spark, sf):
    months = c.monthly_summary(nation_days(spark, sf), min_days=0)
    return c.ordered_summary(months, ["complex_id", "year", "month"])


@bind("sort_observations", sql("SELECT * FROM obs"))
def sort_observations(spark, sf):
    return c.sort_observations(observations(spark, sf))


FIVE = (1996, 1997, 1998, 1999, 2000)


@bind(
    "fanout_join_aggregate",
    sql(
        """
        SELECT complex_id, year, avg(mean_daily_entries) AS mean_daily_entries,
               CAST(sum(total_entries) AS BIGINT) AS total_entries,
               avg(mean_daily_exits) AS mean_daily_exits,
               CAST(sum(total_exits) AS BIGINT) AS total_exits
        FROM annual JOIN stops USING (complex_id) GROUP BY complex_id, year
        """
    ),
)
def fanout_join_aggregate(spark, sf):
    annual = c.annual_summary(nation_days(spark, sf))
    return j.fanout_join_aggregate(stops(spark, sf), annual, fanout=True)


@bind(
    "fanout_join_aggregate_once",
    sql("SELECT * REPLACE (CAST(mean_daily_entries AS DOUBLE) AS mean_daily_entries,"
        " CAST(mean_daily_exits AS DOUBLE) AS mean_daily_exits) FROM annual"
        " WHERE complex_id IN (SELECT complex_id FROM stops)"),
)
def fanout_join_aggregate_once(spark, sf):
    annual = c.annual_summary(nation_days(spark, sf))
    return j.fanout_join_aggregate(stops(spark, sf), annual, fanout=False)


@bind(
    "multiway_left_join",
    sql(
        "SELECT y2000.complex_id, "
        + ", ".join(f"y{y}.total_entries AS total_entries_{y}" for y in FIVE)
        + " FROM (SELECT * FROM annual WHERE year = 2000) y2000"
        + "".join(
            f" LEFT JOIN (SELECT * FROM annual WHERE year = {y}) y{y}"
            f" ON y{y}.complex_id = y2000.complex_id"
            for y in FIVE[:-1]
        )
    ),
)
def multiway_left_join(spark, sf):
    annual = c.annual_summary(nation_days(spark, sf))
    return j.multiway_left_join(annual, FIVE, ["total_entries"])


@bind(
    "multi_year_mean",
    sql(
        f"""
        SELECT complex_id, CASE WHEN count(*) = 5
               THEN CAST(sum(mean_daily_entries) AS DOUBLE) / 5 END AS mean_daily_entries_all
        FROM annual WHERE year IN {FIVE}
        GROUP BY complex_id HAVING max(year) = 2000
        """
    ),
)
def multi_year_mean(spark, sf):
    annual = c.annual_summary(nation_days(spark, sf))
    wide = j.multiway_left_join(annual, FIVE, ["mean_daily_entries"])
    mean = j.multi_year_mean([f"mean_daily_entries_{y}" for y in FIVE])
    return wide.select("complex_id", mean.alias("mean_daily_entries_all"))


@bind(
    "centroid_of_group",
    sql(
        "SELECT complex_id, round(avg(x), 6) AS x, round(avg(y), 6) AS y FROM stops GROUP BY complex_id"
    ),
)
def centroid_of_group(spark, sf):
    centres = j.centroid_of_group(stops(spark, sf), "complex_id")
    return centres.select("complex_id", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


def _wide_sql() -> str:
    picks = []
    for m in ("mean_daily_entries", "mean_daily_exits", "total_entries", "total_exits"):
        kind = "DOUBLE" if m.startswith("mean") else "BIGINT"
        for y in FIVE:
            picks.append(f"CAST(max({m}) FILTER (year = {y}) AS {kind}) AS {m}_{y}")
        over = f"CAST(sum({m}) AS {kind})" + (" / 5" if m.startswith("mean") else "")
        picks.append(f"CASE WHEN count(*) = 5 THEN {over} END AS {m}_all")
    return (
        "SELECT complex_id, x, y, " + ", ".join(picks) + f" FROM annual JOIN ("
        "SELECT complex_id, round(avg(x), 6) AS x, round(avg(y), 6) AS y FROM stops"
        f" GROUP BY complex_id) USING (complex_id) WHERE year IN {FIVE}"
        " GROUP BY complex_id, x, y HAVING max(year) = 2000"
    )


@bind("annual_by_year", sql(_wide_sql()))
def wide_years(spark, sf):
    annual = c.annual_summary(nation_days(spark, sf))
    wide = annual_by_year(annual, stops(spark, sf), FIVE)
    return wide.withColumns({"x": F.round("x", 6), "y": F.round("y", 6)})


@bind(
    "reject_null_rows",
    "SELECT c_custkey, c_mktsegment, c_acctbal AS balance FROM customer WHERE c_acctbal > 0",
)
def rejected(spark, sf):
    rows = table(spark, sf, "customer").select(
        "c_custkey", "c_mktsegment", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("balance")
    )
    return reject_null_rows(rows, ["c_custkey", "c_mktsegment", "balance"])


@bind(
    "turnstile_pipeline",
    sql(
        """
        SELECT period, complex_id, CAST(year(date) AS INTEGER) AS year,
               CAST(trunc(avg(entries)) AS BIGINT) AS mean_daily_entries,
               CAST(sum(entries) AS BIGINT) AS total_entries,
               CAST(trunc(avg(exits)) AS BIGINT) AS mean_daily_exits,
               CAST(sum(exits) AS BIGINT) AS total_exits
        FROM (
            SELECT period, coalesce(complex_id, remoteunit) AS complex_id, date,
                   sum(entries) AS entries, sum(exits) AS exits
            FROM (SELECT 'all' AS period, * FROM daily UNION ALL SELECT * FROM daily_period)
            LEFT JOIN (SELECT DISTINCT remote, complex_id FROM lookup) ON remoteunit = remote
            GROUP BY ALL
        ) GROUP BY ALL
        """
    ),
)
def pipeline(spark, sf):
    return turnstile_tables(observations(spark, sf), lookup(spark, sf))["annual_complex"]
