"""Turnstile operators on reads written by hand."""

import datetime as dt
import sqlite3

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from dockwise.functions.calendar import service_day, transit_period
from dockwise.operators import counters as c
from dockwise.operators.ordered import RUN
from dockwise.operators.joins import fanout_join_aggregate, multiway_left_join
from dockwise.plans.turnstile import annual_by_year, turnstile_tables

SCHEMA = "id string, unit_id string, remoteunit string, observed_at timestamp_ntz, entries long, exits long, filename string"


def at(text):
    return dt.datetime.strptime(text, "%Y-%m-%d %H:%M")


# one unit: a usual step, a reset, a jump, gaps of 24 h and 24 h 1 min, a tie
READS = [
    ("a1", "A", "R1", at("2023-03-03 01:59"), 100, 10, "f"),
    ("a2", "A", "R1", at("2023-03-03 05:59"), 150, 30, "f"),
    ("a3", "A", "R1", at("2023-03-03 09:59"), 20, 31, "f"),
    ("a4", "A", "R1", at("2023-03-03 13:59"), 10020, 32, "f"),
    ("a5", "A", "R1", at("2023-03-04 13:59"), 10021, 40, "f"),
    ("a6", "A", "R1", at("2023-03-05 14:00"), 10022, 50, "f"),
    ("a7", "A", "R1", at("2023-03-05 18:00"), 10032, 60, "f"),
    ("a7", "A", "R1", at("2023-03-05 18:00"), 10032, 60, "g"),
    ("b1", "B", "R2", at("2023-03-03 02:00"), 5, 5, "f"),
    ("b2", "B", "R2", at("2023-03-03 05:00"), 7, 6, "f"),
    ("b3", "B", "R2", at("2023-03-03 10:00"), 9, 9, "f"),
]


@pytest.fixture(scope="module")
def reads(spark):
    return spark.createDataFrame(READS, SCHEMA)


def test_net_counts(reads):
    got = rows(c.net_counts(reads), "id", "filename", "net_entries", "net_exits", "hours_difference")
    assert got == sorted(
        [
            ("a1", "f", None, None, None),
            ("a2", "f", 50, 20, 4.0),
            ("a3", "f", 130, 1, 4.0),  # the counter ran back
            ("a4", "f", None, 1, 4.0),  # a jump of 10000
            ("a5", "f", 1, 8, 24.0),  # a gap of a day still counts
            ("a6", "f", None, None, 24 + 1 / 60),
            ("a7", "f", 10, 10, 4.0),
            ("a7", "g", 0, 0, 0.0),  # the same id twice, both kept
            ("b1", "f", None, None, None),
            ("b2", "f", 2, 1, 3.0),
            ("b3", "f", 2, 3, 5.0),
        ],
        key=lambda r: tuple((v is not None, str(v)) for v in r),
    )


def test_regular_interval_is_strict(reads):
    kept = c.filter_regular_interval(c.net_counts(reads))
    assert sorted(r.id for r in kept.collect()) == ["a2", "a3", "a4", "a7"]


def test_service_day_turns_at_two(spark):
    df = spark.createDataFrame(
        [(at("2023-03-03 01:59"),), (at("2023-03-03 02:00"),)], "ts timestamp_ntz"
    )
    days = [r[0] for r in df.select(service_day("ts")).collect()]
    assert days == [dt.date(2023, 3, 2), dt.date(2023, 3, 3)]


def test_periods_split_the_regular_intervals(spark):
    hours = spark.range(24).selectExpr("cast(id as int) period_start_hour")
    grid = hours.join(spark.range(7).selectExpr("cast(id as int) weekday"), F.lit(True) == F.lit(True))
    flags = grid.select(*[transit_period(p).alias(p) for p in c.TRANSIT_PERIODS]).collect()
    assert len(flags) == 168
    for f in flags:
        assert f.peak == (f.morning_peak or f.evening_peak)
        assert f.peak != f.offpeak
    assert sum(f.peak for f in flags) == 8 * 5


def test_weekday_is_of_the_read_and_hour_of_its_start(spark):
    """A read at 01:00 on Monday closes Sunday's 21:00 interval but counts as Monday."""
    read = ("m", "A", "R1", at("2023-03-06 01:00"), 1, 1, "f")
    before = ("l", "A", "R1", at("2023-03-05 21:00"), 0, 0, "f")
    net = c.net_counts(spark.createDataFrame([before, read], SCHEMA))
    starts = c.period_start(net.filter("id = 'm'")).first()
    assert (starts.period_start_hour, starts.weekday) == (21, 1)
    daily = c.daily_period_unit_totals(net).collect()
    assert [(r.period, r.date) for r in daily] == [("offpeak", dt.date(2023, 3, 5))]


def test_lookup_falls_back(spark):
    daily = spark.createDataFrame(
        [("u", "R1", dt.date(2023, 1, 1), 1, 1), ("v", "R2", dt.date(2023, 1, 1), 2, 2),
         ("w", "R3", dt.date(2023, 1, 1), 4, 4)],
        "unit_id string, remoteunit string, date date, entries long, exits long",
    )
    lookup = spark.createDataFrame(
        [("R1", "c1"), ("R1", "c1"), ("R2", None)], "remote string, complex_id string"
    )
    got = rows(c.daily_group_totals(daily, lookup), "complex_id", "entries")
    assert got == [("R2", 2), ("R3", 4), ("c1", 1)]


def test_monthly_needs_more_than_ten_days(spark):
    days = [("c", dt.date(2023, 1, d), 3 * d, 1) for d in range(1, 12)]
    days += [("c", dt.date(2023, 2, d), 1, 1) for d in range(1, 11)]
    daily = spark.createDataFrame(days, "complex_id string, date date, entries long, exits long")
    got = rows(c.monthly_summary(daily), "year", "month", "mean_daily_entries", "total_entries")
    assert got == [(2023, 1, 18, 198)]
    short = spark.createDataFrame(
        [("c", dt.date(2023, 1, 1), -1, 1), ("c", dt.date(2023, 1, 2), -2, 2)],
        "complex_id string, date date, entries long, exits long",
    )
    assert rows(c.annual_summary(short), "mean_daily_entries", "mean_daily_exits") == [(-1, 1)]


def test_fanout_multiplies_totals_only(spark):
    stations = spark.createDataFrame([("c", 0.0, 0.0), ("c", 2.0, 4.0)], "complex_id string, x double, y double")
    annual = spark.createDataFrame(
        [("c", 2023, 5, 50, 6, 60), ("d", 2023, 1, 1, 1, 1)],
        "complex_id string, year int, mean_daily_entries long, total_entries long,"
        " mean_daily_exits long, total_exits long",
    )
    assert rows(fanout_join_aggregate(stations, annual), "mean_daily_entries", "total_entries") == [(5.0, 50)]
    assert rows(
        fanout_join_aggregate(stations, annual, fanout=True), "mean_daily_entries", "total_entries"
    ) == [(5.0, 100)]
    wide = annual_by_year(annual, stations, [2022, 2023]).first()
    assert (wide.x, wide.y) == (1.0, 2.0)
    assert wide.total_entries_2023 == 50
    assert wide.total_entries_2022 is None and wide.mean_daily_entries_all is None


def test_latest_year_decides(spark):
    annual = spark.createDataFrame(
        [("c", 2022, 1), ("d", 2022, 1), ("d", 2023, 2)], "complex_id string, year int, total long"
    )
    assert rows(multiway_left_join(annual, [2022, 2023], ["total"])) == [("d", 1, 2)]


def test_hot_unit_is_spread_and_right(spark):
    """A unit with a third of the reads gives what a plain window gives, a day at a time."""
    hot = spark.range(30_000).select(
        F.lit("hot").alias("unit_id"), F.col("id"),
        (F.lit("2023-01-01").cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("id"))).alias("observed_at"),
    )
    cold = spark.range(60_000).select(
        F.concat(F.lit("u"), F.col("id") % 997).alias("unit_id"), (F.col("id") + 100_000).alias("id"),
        (F.lit("2023-01-01").cast("timestamp_ntz") + F.make_dt_interval(mins=F.hash("id") % 500_000)).alias("observed_at"),
    )
    reads = hot.unionByName(cold).withColumns(
        {"entries": F.abs(F.hash("id", F.lit(1))) % 20_000, "exits": F.abs(F.hash("id", F.lit(2))) % 20_000}
    )
    net = c.grouped_net_counts(reads, run_days=1)
    w = W.partitionBy("unit_id").orderBy("observed_at", "id")
    delta = F.abs(F.col("entries") - F.lag("entries").over(w))
    gap = (F.unix_seconds(F.col("observed_at").cast("timestamp"))
           - F.lag(F.unix_seconds(F.col("observed_at").cast("timestamp"))).over(w))
    plain = reads.withColumns({"d": delta, "g": gap}).select(
        "id", F.when((F.col("d") < 10000) & (F.col("g") <= 86400), F.col("d")).cast("long").alias("net_entries")
    )
    ours = net.select("id", "net_entries")
    assert ours.count() == 90_000
    assert ours.exceptAll(plain).count() == 0
    # the hot unit of 21 days lies in as many runs, none of them above a day's reads
    groups = net.groupBy("unit_id", RUN).count()
    assert groups.agg(F.max("count")).first()[0] <= 24 * 60
    assert groups.filter("unit_id = 'hot'").count() >= 20
    # the rows are shuffled once, their pre-aggregate twice; daily totals add nothing
    daily = c.daily_unit_totals(net, remote="unit_id")
    plan = daily._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(unit_id") == 3
    want = c.daily_unit_totals(c.net_counts(reads), remote="unit_id")
    assert daily.count() == want.count() and daily.exceptAll(want).count() == 0
    assert c.net_counts(reads).columns == [*reads.columns, "hours_difference", "net_entries", "net_exits"]
    for made in (c.counter_delta(reads), c.gap_hours(reads)):
        assert not [x for x in made.columns if x.startswith("_") or x in ("service_day", "day_slice")]


def test_no_sort_aggregate_for_totals(spark, reads):
    """Daily sums aggregate by hash before the few rows of a day are ordered by remote."""
    plan = c.daily_unit_totals(c.net_counts(reads))._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in "".join(line for line in plan.splitlines() if "sum(net_entries" in line)


def test_repeated_reads(spark, reads):
    twice = reads.unionByName(reads.withColumn("id", F.concat("id", F.lit("-again"))))
    cols = ["unit_id", "observed_at", "net_entries", "net_exits", "hours_difference"]
    got = rows(c.net_counts(twice, dedupe=True), *cols)
    assert got == rows(c.net_counts(reads, dedupe=True), *cols)
    assert len(got) < reads.count() < c.net_counts(twice).count()  # one read stands there twice to begin with


def test_building_runs_no_job(spark, reads):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "no job while a plan is built")
    c.net_counts(reads)
    c.counter_delta(reads)
    c.gap_hours(reads)
    assert not tracker.getJobIdsForGroup("building")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_hot_unit_without_dates(spark):
    """Reads without a time come first; the carried row finds the next slice that has rows."""
    days = ["2023-01-01", "2023-01-02", "2023-03-01", "2023-03-05"]
    moments = [None, None] + [dt.datetime.fromisoformat(f"{d} 0{h}:00:00") for d in days for h in (3, 5, 7)]
    reads = spark.createDataFrame(
        [(f"{i:03d}", unit, unit, m, i, i, "f") for unit in ("hot", None) for i, m in enumerate(moments)], SCHEMA
    )
    cols = ["unit_id", "id", "net_entries", "hours_difference"]
    assert rows(c.net_counts(reads, run_days=1), *cols) == rows(c.net_counts(reads, run_days=9999), *cols)


def test_against_sqlite(spark, reads):
    """The same rules asked of SQLite: daily totals of the pipeline."""
    con = sqlite3.connect(":memory:")
    con.execute("CREATE TABLE r (id, unit, remote, at, entries INTEGER, exits INTEGER, f)")
    con.executemany(
        "INSERT INTO r VALUES (?, ?, ?, ?, ?, ?, ?)",
        [(i, u, m, t.strftime("%Y-%m-%d %H:%M:%S"), e, x, f) for i, u, m, t, e, x, f in READS],
    )
    want = con.execute(
        """
        SELECT unit, date(at, '-2 hours') AS day,
               sum(CASE WHEN abs(de) < 10000 AND gap <= 86400 THEN abs(de) END),
               sum(CASE WHEN abs(dx) < 10000 AND gap <= 86400 THEN abs(dx) END)
        FROM (SELECT unit, at, entries - lag(entries) OVER w AS de, exits - lag(exits) OVER w AS dx,
                     strftime('%s', at) - lag(strftime('%s', at)) OVER w AS gap
              FROM r WINDOW w AS (PARTITION BY unit ORDER BY at, id, f))
        GROUP BY 1, 2
        """
    ).fetchall()
    got = c.daily_unit_totals(c.net_counts(reads)).select(
        "unit_id", F.col("date").cast("string"), "entries", "exits"
    )
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_pipeline_keeps_years_apart(spark, reads):
    lookup = spark.createDataFrame([("R1", "c1")], "remote string, complex_id string")
    tables = turnstile_tables(reads, lookup)
    annual = rows(tables["annual_complex"].filter("period = 'all'"), "complex_id", "year", "total_exits")
    assert annual == [("R2", 2023, 4), ("c1", 2023, 50 - 10)]
    assert tables["monthly_complex"].count() == 0
