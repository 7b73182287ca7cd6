"""Registry of bound queries, shared SQL pieces and table readers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
PIECES: dict[str, str] = {}


def bind(key: str, sql: str | None = None):
    """Register a query under a key, with the SQL that gives the same rows."""

    def add(query):
        QUERIES[key] = query
        if sql is not None:
            SQL[key] = sql
        return query

    return add


def piece(name: str, text: str) -> None:
    """A named subquery; later pieces may read earlier ones."""
    PIECES[name] = text.strip()


def sql(body: str) -> str:
    """A statement with every piece it needs in front, directly or through others."""
    import re

    wanted: set[str] = set()

    def visit(text: str) -> None:
        for name in PIECES:
            if name not in wanted and re.search(rf"\b{name}\b", text):
                wanted.add(name)
                visit(PIECES[name])

    visit(body)
    parts = [f"{name} AS (\n{PIECES[name]}\n)" for name in PIECES if name in wanted]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body.strip()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- turnstile reads: events, unit = user, counters from value and props ---

piece(
    "obs",
    """
    SELECT event_id AS id, user_id AS unit_id, CAST(user_id AS VARCHAR) AS remoteunit,
           ts AS observed_at, CAST(round(value * 100) AS BIGINT) AS entries,
           CAST(json_extract_string(props, '$.k') AS BIGINT) AS exits
    FROM events
    """,
)


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("unit_id"),
        F.col("user_id").cast("string").alias("remoteunit"),
        F.col("ts").alias("observed_at"),
        F.round(F.col("value") * 100).cast("long").alias("entries"),
        F.get_json_object("props", "$.k").cast("long").alias("exits"),
    )


piece(
    "lookup",
    """
    SELECT CAST(c_custkey AS VARCHAR) AS remote,
           CASE WHEN c_mktsegment <> 'BUILDING' THEN CAST(c_nationkey AS VARCHAR) END AS complex_id
    FROM customer
    """,
)


def lookup(spark: SparkSession, sf_dir: str, known: str = "true") -> DataFrame:
    customer = table(spark, sf_dir, "customer").filter(known)
    return customer.select(
        F.col("c_custkey").cast("string").alias("remote"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_nationkey").cast("string")).alias(
            "complex_id"
        ),
    )


piece(
    "net",
    """
    SELECT id, unit_id, remoteunit, observed_at, entries, exits, hours_difference,
           CASE WHEN abs(de) < 10000 AND hours_difference <= 24 THEN abs(de) END AS net_entries,
           CASE WHEN abs(dx) < 10000 AND hours_difference <= 24 THEN abs(dx) END AS net_exits
    FROM (
        SELECT *, entries - lag(entries) OVER w AS de, exits - lag(exits) OVER w AS dx,
               (epoch_us(observed_at) - epoch_us(lag(observed_at) OVER w)) / 3.6e9
                   AS hours_difference
        FROM obs WINDOW w AS (PARTITION BY unit_id ORDER BY observed_at, id)
    )
    """,
)
piece(
    "daily",
    """
    SELECT unit_id, CAST(observed_at - INTERVAL 2 HOURS AS DATE) AS date,
           CAST(sum(net_entries) AS BIGINT) AS entries, CAST(sum(net_exits) AS BIGINT) AS exits,
           min(remoteunit) AS remoteunit
    FROM net GROUP BY ALL
    """,
)
piece(
    "starts",
    """
    SELECT *, CAST(hour(observed_at - INTERVAL 4 HOURS) AS INTEGER) AS period_start_hour,
           CAST(dayofweek(observed_at) AS INTEGER) AS weekday
    FROM net WHERE hours_difference > 3 AND hours_difference < 5
    """,
)
piece(
    "period_starts",
    """
    SELECT 'morning_peak' AS period, * FROM starts
    WHERE period_start_hour IN (4, 5, 6, 7) AND weekday IN (1, 2, 3, 4, 5)
    UNION ALL
    SELECT 'evening_peak' AS period, * FROM starts
    WHERE period_start_hour IN (14, 15, 16, 17) AND weekday IN (1, 2, 3, 4, 5)
    UNION ALL
    SELECT 'peak' AS period, * FROM starts
    WHERE period_start_hour IN (4, 5, 6, 7, 14, 15, 16, 17) AND weekday IN (1, 2, 3, 4, 5)
    UNION ALL
    SELECT 'offpeak' AS period, * FROM starts
    WHERE period_start_hour NOT IN (4, 5, 6, 7, 14, 15, 16, 17) OR weekday IN (0, 6)
    """,
)
piece(
    "daily_period",
    """
    SELECT period, unit_id, CAST(observed_at - INTERVAL 2 HOURS AS DATE) AS date,
           CAST(sum(net_entries) AS BIGINT) AS entries, CAST(sum(net_exits) AS BIGINT) AS exits,
           min(remoteunit) AS remoteunit
    FROM period_starts GROUP BY ALL
    """,
)

# --- daily table of a group over years: orders by nation and day ---

piece(
    "nation_days",
    """
    SELECT CAST(c_nationkey AS VARCHAR) AS complex_id, CAST(o_orderdate AS DATE) AS date,
           CAST(sum(CAST(round(o_totalprice) AS BIGINT)) AS BIGINT) AS entries,
           CAST(count(*) AS BIGINT) AS exits
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL
    """,
)


def nation_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy(
        F.col("c_nationkey").cast("string").alias("complex_id"),
        F.to_date("o_orderdate").alias("date"),
    ).agg(
        F.sum(F.round("o_totalprice").cast("long")).alias("entries"),
        F.count(F.lit(1)).alias("exits"),
    )


piece(
    "annual",
    """
    SELECT complex_id, CAST(year(date) AS INTEGER) AS year,
           CAST(trunc(avg(entries)) AS BIGINT) AS mean_daily_entries,
           CAST(sum(entries) AS BIGINT) AS total_entries,
           CAST(trunc(avg(exits)) AS BIGINT) AS mean_daily_exits,
           CAST(sum(exits) AS BIGINT) AS total_exits
    FROM nation_days GROUP BY ALL
    """,
)
# stations of a group: suppliers of a nation
piece(
    "stops",
    """
    SELECT s_suppkey AS stop_id, CAST(s_nationkey AS VARCHAR) AS complex_id,
           s_acctbal AS x, CAST(s_suppkey AS DOUBLE) AS y
    FROM supplier
    """,
)


def stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("stop_id"),
        F.col("s_nationkey").cast("string").alias("complex_id"),
        F.col("s_acctbal").alias("x"),
        F.col("s_suppkey").cast("double").alias("y"),
    )


# --- status log: events cut to the hour; stations: customers ---

piece(
    "status",
    """
    SELECT event_id AS objectid, user_id AS station_id, date_trunc('hour', ts) AS reported_datetime,
           CAST(floor(value) AS INTEGER) % 20 AS num_bikes_available,
           CAST(event_id % 20 AS INTEGER) AS num_docks_available, ts AS capture_datetime
    FROM events
    """,
)


def status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("objectid"),
        F.col("user_id").alias("station_id"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("reported_datetime"),
        (F.floor("value").cast("int") % 20).alias("num_bikes_available"),
        (F.col("event_id") % 20).cast("int").alias("num_docks_available"),
        F.col("ts").alias("capture_datetime"),
    )


piece(
    "station",
    """
    SELECT c_custkey AS station_id, c_nationkey AS capacity, c_acctbal AS x,
           CAST(c_custkey AS DOUBLE) AS y
    FROM customer
    """,
)


def station(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("station_id"),
            F.col("c_nationkey").alias("capacity"),
            F.col("c_acctbal").alias("x"),
            F.col("c_custkey").cast("double").alias("y"),
        )
    )


piece(
    "flagged",
    """
    SELECT *, CASE WHEN lag(reported_datetime) OVER w = reported_datetime THEN 1 ELSE 0 END AS stale,
           CAST(hour(reported_datetime) AS INTEGER) AS reported_hour,
           CAST(isodow(reported_datetime) - 1 AS INTEGER) AS reported_weekday
    FROM status WINDOW w AS (PARTITION BY station_id ORDER BY reported_datetime, objectid)
    """,
)
piece(
    "reports",
    """
    SELECT flagged.*, capacity,
           CASE WHEN capacity <> 0
                THEN CAST(num_bikes_available AS DOUBLE) / capacity END AS perc_capacity_available,
           CASE WHEN num_docks_available + num_bikes_available <> 0
                THEN CAST(num_bikes_available AS DOUBLE)
                     / (num_docks_available + num_bikes_available) END AS perc_enabled_available
    FROM flagged JOIN station USING (station_id)
    """,
)
piece(
    "period_reports",
    """
    SELECT 'all' AS period, * FROM reports
    UNION ALL
    SELECT 'morning_peak' AS period, * FROM reports
    WHERE reported_weekday BETWEEN 0 AND 4 AND reported_hour IN (6, 7, 8, 9) AND stale = 0
    UNION ALL
    SELECT 'evening_peak' AS period, * FROM reports
    WHERE reported_weekday BETWEEN 0 AND 4 AND reported_hour IN (16, 17, 18, 19) AND stale = 0
    UNION ALL
    SELECT 'peak' AS period, * FROM reports
    WHERE reported_weekday BETWEEN 0 AND 4
      AND reported_hour IN (6, 7, 8, 9, 16, 17, 18, 19) AND stale = 0
    UNION ALL
    SELECT 'offpeak' AS period, * FROM reports
    WHERE (reported_hour NOT IN (6, 7, 8, 9, 16, 17, 18, 19)
           OR reported_weekday BETWEEN 5 AND 6) AND stale = 0
    """,
)

# --- trips: line items from supplier to part; station ids change in February 1998 ---

YEARS = tuple(range(1995, 2002))
SWITCH = (1998, 2)
piece(
    "trips",
    """
    SELECT l_orderkey, l_linenumber, l_shipdate AS started_at,
           l_suppkey + CASE WHEN l_shipdate < TIMESTAMP '1998-02-01' THEN 0 ELSE 1000000 END
               AS start_station_id,
           l_partkey % (SELECT count(*) FROM supplier)
               + CASE WHEN l_shipdate < TIMESTAMP '1998-02-01' THEN 0 ELSE 1000000 END
               AS end_station_id,
           l_quantity, l_extendedprice
    FROM lineitem
    """,
)


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    stations = table(spark, sf_dir, "supplier").agg(F.count(F.lit(1)).alias("n"))
    shift = F.when(F.col("l_shipdate") < F.lit("1998-02-01").cast("timestamp_ntz"), 0).otherwise(
        1_000_000
    )
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_shipdate").alias("started_at"),
        (F.col("l_suppkey") + shift).alias("start_station_id"),
        (F.col("l_partkey") % stations.scalar() + shift).alias("end_station_id"),
        "l_quantity",
        "l_extendedprice",
    )


piece(
    "docks",
    """
    SELECT s_suppkey AS station_id, s_suppkey AS legacy_id, s_suppkey + 1000000 AS short_name,
           s_nationkey AS capacity
    FROM supplier
    """,
)


def docks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("station_id"),
        F.col("s_suppkey").alias("legacy_id"),
        (F.col("s_suppkey") + 1_000_000).alias("short_name"),
        F.col("s_nationkey").alias("capacity"),
    )
