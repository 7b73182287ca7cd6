"""Trip operators on lineitem and supplier."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.registry import SWITCH, YEARS, bind, docks, piece, sql, table, trips
from dockwise.operators import clean, joins
from dockwise.operators import trips as t
from dockwise.plans.trips import trip_tables

FIXED = {1998: 365}

piece("moving", "SELECT * FROM trips WHERE start_station_id <> end_station_id")
piece("begun", "SELECT start_station_id AS station_id, count(*) AS start_trips FROM moving GROUP BY ALL")
piece("ended", "SELECT end_station_id AS station_id, count(*) AS end_trips FROM moving GROUP BY ALL")


@bind("exclude_round_trips", sql("SELECT l_orderkey, l_linenumber FROM moving"))
def exclude_round_trips(spark, sf):
    return clean.exclude_round_trips(trips(spark, sf)).select("l_orderkey", "l_linenumber")


@bind(
    "filter_month",
    "SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem WHERE month(l_shipdate) > 1",
)
def filter_month(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return clean.filter_month(rows, "l_shipdate", range(2, 13))


@bind(
    "filter_complete_trips",
    sql(
        """
        SELECT l_orderkey, l_linenumber, a AS start_station_id, b AS end_station_id FROM (
            SELECT l_orderkey, l_linenumber,
                   CASE WHEN l_returnflag <> 'A' THEN l_suppkey END AS a,
                   CASE WHEN l_linestatus <> 'F' THEN l_partkey END AS b FROM lineitem)
        WHERE a IS NOT NULL AND b IS NOT NULL
        """
    ),
)
def filter_complete_trips(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_returnflag") != "A", F.col("l_suppkey")).alias("start_station_id"),
        F.when(F.col("l_linestatus") != "F", F.col("l_partkey")).alias("end_station_id"),
    )
    return clean.filter_complete_trips(rows)


@bind("trip_starts", sql("SELECT * FROM begun"))
def trip_starts(spark, sf):
    return t.trip_starts(trips(spark, sf))


@bind("trip_ends", sql("SELECT * FROM ended"))
def trip_ends(spark, sf):
    return t.trip_ends(trips(spark, sf))


@bind(
    "trip_ends_by_station",
    sql(
        """
        SELECT station_id AS id, coalesce(start_trips, 0) AS start_trips,
               coalesce(end_trips, 0) AS end_trips
        FROM begun FULL JOIN ended USING (station_id)
        """
    ),
)
def trip_ends_by_station(spark, sf):
    return t.trip_ends_by_station(trips(spark, sf))


def _joined(fill: bool) -> str:
    total = "coalesce(start_trips, 0) + coalesce(end_trips, 0)" if fill else "start_trips + end_trips"
    return sql(
        f"""
        SELECT p_partkey AS station_id, p_size, {total} AS total_trips FROM part
        LEFT JOIN begun ON begun.station_id = p_partkey
        LEFT JOIN ended ON ended.station_id = p_partkey
        """
    )


def _parts_as_stations(spark, sf):
    return table(spark, sf, "part").select(F.col("p_partkey").alias("station_id"), "p_size")


@bind("join_starts_ends", _joined(False))
def join_starts_ends(spark, sf):
    rows = trips(spark, sf)
    return t.join_starts_ends(_parts_as_stations(spark, sf), t.trip_starts(rows), t.trip_ends(rows))


@bind("join_starts_ends_filled", _joined(True))
def join_starts_ends_filled(spark, sf):
    rows = trips(spark, sf)
    return t.join_starts_ends(
        _parts_as_stations(spark, sf), t.trip_starts(rows), t.trip_ends(rows), fill_zero=True
    )


@bind("active_days", "SELECT count(DISTINCT CAST(l_shipdate AS DATE)) AS days FROM lineitem")
def active_days(spark, sf):
    return t.active_days(trips(spark, sf))


@bind(
    "cross_join_scalar",
    """
    SELECT s_suppkey, s_acctbal / days AS balance_per_day FROM supplier,
        (SELECT count(DISTINCT CAST(l_shipdate AS DATE)) AS days FROM lineitem)
    """,
)
def cross_join_scalar(spark, sf):
    rows = joins.cross_join_scalar(table(spark, sf, "supplier"), t.active_days(trips(spark, sf)))
    return rows.select("s_suppkey", (F.col("s_acctbal") / F.col("days")).alias("balance_per_day"))


@bind(
    "join_station_by_id_era",
    sql(
        """
        SELECT l_orderkey, l_linenumber, start_station_id, station_id
        FROM trips LEFT JOIN docks
          ON start_station_id = CASE WHEN started_at < TIMESTAMP '1998-02-01'
                                     THEN legacy_id ELSE short_name END
        """
    ),
)
def join_station_by_id_era(spark, sf):
    rows = t.join_station_by_id_era(trips(spark, sf), docks(spark, sf), switch=SWITCH)
    return rows.select("l_orderkey", "l_linenumber", "start_station_id", "station_id")


def _year_totals(year: int) -> str:
    """Totals of one year as station_id, total."""

    def part(name: str, id_col: str, months: str) -> str:
        return f"""
            SELECT docks.station_id, b.n + e.n AS {name} FROM docks
            LEFT JOIN (SELECT start_station_id AS id, count(*) AS n FROM moving
                       WHERE year(started_at) = {year} {months} GROUP BY ALL) b ON b.id = {id_col}
            LEFT JOIN (SELECT end_station_id AS id, count(*) AS n FROM moving
                       WHERE year(started_at) = {year} {months} GROUP BY ALL) e ON e.id = {id_col}
        """

    if year == SWITCH[0]:
        first = part("t1", "legacy_id", "AND month(started_at) = 1")
        rest = part("t2", "short_name", "AND month(started_at) > 1")
        return f"SELECT station_id, t1 + t2 AS total FROM ({first}) JOIN ({rest}) USING (station_id)"
    id_col = "legacy_id" if year < SWITCH[0] else "short_name"
    return part("total", id_col, "")


def _year_summary(year: int) -> str:
    days = (
        str(FIXED[year])
        if year in FIXED
        else f"(SELECT count(DISTINCT CAST(started_at AS DATE)) FROM trips WHERE year(started_at) = {year})"
    )
    return f"""
        SELECT {year} AS year, station_id, capacity, total AS total_trips,
               CASE WHEN capacity <> 0 THEN CAST(total AS DOUBLE) / capacity END AS trips_per_dock,
               CAST(total AS DOUBLE) / {days} AS trips_per_day,
               CASE WHEN capacity <> 0
                    THEN CAST(total AS DOUBLE) / ({days} * capacity) END AS trips_per_day_per_dock
        FROM docks JOIN ({_year_totals(year)}) USING (station_id)
    """


piece("yearly", " UNION ALL ".join(_year_summary(y) for y in YEARS))


@bind("trips_summary_year", sql("SELECT * FROM yearly"))
def trips_summary_year(spark, sf):
    return t.trips_summary_year(
        trips(spark, sf), docks(spark, sf), YEARS, days=FIXED, switch=SWITCH
    )


@bind(
    "trips_summary_all",
    sql(
        """
        SELECT station_id, capacity, total_trips, round(trips_per_day, 9) AS trips_per_day,
               round(trips_per_day_per_dock, 9) AS trips_per_day_per_dock,
               CASE WHEN capacity <> 0 THEN total_trips // capacity END AS trips_per_dock
        FROM docks LEFT JOIN (
            SELECT station_id, CAST(sum(total_trips) AS BIGINT) AS total_trips,
                   avg(trips_per_day) AS trips_per_day,
                   avg(trips_per_day_per_dock) AS trips_per_day_per_dock
            FROM yearly GROUP BY station_id) USING (station_id)
        """
    ),
)
def trips_summary_all(spark, sf):
    yearly = trips_summary_year(spark, sf)
    every = t.trips_summary_all(yearly, docks(spark, sf).select("station_id", "capacity"))
    rates = ("trips_per_day", "trips_per_day_per_dock")
    return every.withColumns({r: F.round(r, 9) for r in rates})


@bind(
    "union_years",
    "SELECT year(l_shipdate) AS year, l_orderkey, l_linenumber FROM lineitem".replace(
        "year(l_shipdate)", "CAST(year(l_shipdate) AS INTEGER)"
    ),
)
def union_years(spark, sf):
    rows = table(spark, sf, "lineitem")
    first, last = YEARS[0], YEARS[-1]
    years = [
        rows.filter(F.year("l_shipdate") == y) for y in range(first, last + 1)
    ] + [rows.filter((F.year("l_shipdate") < first) | (F.year("l_shipdate") > last))]
    picked = [y.select(F.year("l_shipdate").alias("year"), "l_orderkey", "l_linenumber") for y in years]
    return joins.union_years(*picked)


# per supplier the first known flag and the first known status, each in order of time
@bind(
    "first_non_null_per_key",
    """
    SELECT l_suppkey, arg_min(flag, (l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice))
               FILTER (flag IS NOT NULL) AS flag,
           arg_min(status, (l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice))
               FILTER (status IS NOT NULL) AS status
    FROM (SELECT *, CASE WHEN l_quantity > 10 THEN l_returnflag END AS flag,
                 CASE WHEN l_discount > 0 THEN l_linestatus END AS status FROM lineitem)
    GROUP BY l_suppkey
    """,
)
def first_non_null_per_key(spark, sf):
    rows = table(spark, sf, "lineitem").withColumns(
        {
            "flag": F.when(F.col("l_quantity") > 10, F.col("l_returnflag")),
            "status": F.when(F.col("l_discount") > 0, F.col("l_linestatus")),
        }
    )
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]
    return t.first_non_null_per_key(rows, "l_suppkey", ["flag", "status"], order)


@bind(
    "union_distinct_stations",
    sql(
        """
        SELECT CAST(c_custkey AS BIGINT) AS station_id, c_acctbal AS balance FROM customer
        UNION ALL
        SELECT p_partkey, p_retailprice FROM part
        WHERE p_partkey NOT IN (SELECT c_custkey FROM customer)
        """
    ),
)
def union_distinct_stations(spark, sf):
    starts = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("station_id"), F.col("c_acctbal").alias("balance")
    )
    ends = table(spark, sf, "part").select(
        F.col("p_partkey").alias("station_id"), F.col("p_retailprice").alias("balance")
    )
    return t.union_distinct_stations(starts, ends)


@bind(
    "anti_join_new",
    "SELECT p_partkey, p_name FROM part WHERE p_partkey NOT IN (SELECT s_suppkey FROM supplier)",
)
def anti_join_new(spark, sf):
    existing = table(spark, sf, "supplier").withColumnRenamed("s_suppkey", "p_partkey")
    return joins.anti_join_new(table(spark, sf, "part").select("p_partkey", "p_name"), existing, "p_partkey")


# a trip's end: the order's day shifted by the line's number and quantity
piece(
    "timed",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate AS started_at,
           l_shipdate + to_seconds(CAST(l_quantity * 61 + l_linenumber AS BIGINT)) AS ended_at
    FROM lineitem
    """,
)


def timed(spark, sf):
    seconds = (F.col("l_quantity") * 61 + F.col("l_linenumber")).cast("long")
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.col("l_shipdate").alias("started_at"),
        (F.col("l_shipdate") + F.make_dt_interval(secs=seconds)).alias("ended_at"),
    )


@bind(
    "trip_duration",
    sql("SELECT *, date_diff('second', started_at, ended_at) AS duration_seconds FROM timed"),
)
def trip_duration(spark, sf):
    return clean.trip_duration(timed(spark, sf))


def _layouts(spark, sf, *keep: str):
    """Line items before 1998 in the older trip layout, the others in the newer one."""
    rows = table(spark, sf, "lineitem").withColumn(
        "end", F.col("l_shipdate") + F.make_dt_interval(secs=F.col("l_quantity").cast("long"))
    )
    since = F.lit("1998-01-01").cast("timestamp_ntz")
    stamp = "yyyy-MM-dd HH:mm:ss"
    old = rows.filter(F.col("l_shipdate") < since).select(
        *keep,
        F.concat(F.date_format("l_shipdate", stamp), F.lit(".1230")).alias("starttime"),
        F.concat(F.date_format("end", stamp), F.lit(".4560")).alias("stoptime"),
        F.col("l_suppkey").cast("string").alias("start station id"),
        F.col("l_returnflag").alias("start station name"),
        F.col("l_discount").cast("string").alias("start station latitude"),
        F.col("l_tax").cast("string").alias("start station longitude"),
        F.col("l_partkey").cast("string").alias("end station id"),
        F.col("l_linestatus").alias("end station name"),
        F.col("l_tax").cast("string").alias("end station latitude"),
        F.col("l_discount").cast("string").alias("end station longitude"),
    )
    new = rows.filter(F.col("l_shipdate") >= since).select(
        *keep,
        F.col("l_returnflag").alias("rideable_type"),
        F.date_format("l_shipdate", stamp).alias("started_at"),
        F.date_format("end", stamp).alias("ended_at"),
        F.col("l_returnflag").alias("start_station_name"),
        F.col("l_suppkey").cast("string").alias("start_station_id"),
        F.col("l_linestatus").alias("end_station_name"),
        F.col("l_partkey").cast("string").alias("end_station_id"),
        F.col("l_discount").cast("string").alias("start_lat"),
        F.col("l_tax").cast("string").alias("start_lng"),
        F.col("l_tax").cast("string").alias("end_lat"),
        F.col("l_discount").cast("string").alias("end_lng"),
        F.col("l_linestatus").alias("member_casual"),
    )
    return old, new


piece(
    "harmonized",
    """
    SELECT CAST(l_suppkey AS VARCHAR) AS start_station_id, l_returnflag AS start_station_name,
           CAST(l_partkey AS VARCHAR) AS end_station_id, l_linestatus AS end_station_name,
           l_tax AS start_lng, l_discount AS start_lat, l_discount AS end_lng, l_tax AS end_lat,
           CASE WHEN l_shipdate >= TIMESTAMP '1998-01-01' THEN l_returnflag END AS rideable_type,
           l_shipdate AS started_at, CAST(l_quantity AS BIGINT) AS duration_seconds,
           l_shipdate + to_seconds(CAST(l_quantity AS BIGINT)) AS ended_at,
           CASE WHEN l_shipdate >= TIMESTAMP '1998-01-01' THEN l_linestatus END AS member_casual
    FROM lineitem
    """,
)


@bind("harmonize_trips", sql("SELECT * FROM harmonized"))
def harmonize_trips(spark, sf):
    return t.harmonize_trips(*_layouts(spark, sf))


SEEN = """
    SELECT {key} AS station_id,
           arg_min({name}, (started_at, {name}, {lng}, {lat})) AS station_name,
           arg_min({lng}, (started_at, {name}, {lng}, {lat})) AS lng,
           arg_min({lat}, (started_at, {name}, {lng}, {lat})) AS lat
    FROM harmonized GROUP BY ALL
"""
piece("begun_at", SEEN.format(key="start_station_id", name="start_station_name", lng="start_lng", lat="start_lat"))
piece("ended_at_station", SEEN.format(key="end_station_id", name="end_station_name", lng="end_lng", lat="end_lat"))


@bind(
    "stations_of_trips",
    sql(
        """
        SELECT * FROM begun_at UNION ALL
        SELECT * FROM ended_at_station WHERE station_id NOT IN (SELECT station_id FROM begun_at)
        """
    ),
)
def stations_of_trips(spark, sf):
    return t.stations_of_trips(t.harmonize_trips(*_layouts(spark, sf)))


@bind(
    "trips_pipeline",
    """
    SELECT station_id, capacity, total_trips FROM (
        SELECT s_suppkey AS station_id, s_nationkey AS capacity FROM supplier)
    LEFT JOIN (
        SELECT station_id, CAST(sum(n) AS BIGINT) AS total_trips FROM (
            SELECT yr, a.station_id, a.n + b.n AS n
            FROM (SELECT year(l_shipdate) AS yr, l_suppkey AS station_id, count(*) AS n
                  FROM lineitem WHERE l_suppkey <> l_partkey GROUP BY ALL) a
            JOIN (SELECT year(l_shipdate) AS yr, l_partkey AS station_id, count(*) AS n
                  FROM lineitem WHERE l_suppkey <> l_partkey GROUP BY ALL) b USING (yr, station_id))
        GROUP BY ALL) USING (station_id)
    """,
)
def trips_pipeline(spark, sf):
    rows = t.harmonize_trips(*_layouts(spark, sf))
    ids = F.col("s_suppkey").cast("string")
    stations = table(spark, sf, "supplier").select(
        "s_suppkey",
        ids.alias("station_id"),
        ids.alias("legacy_id"),
        ids.alias("short_name"),
        F.col("s_nationkey").alias("capacity"),
    )
    every = trip_tables(rows, stations.drop("s_suppkey"), YEARS)["trips_summary"]
    return every.select(F.col("station_id").cast("long").alias("station_id"), "capacity", "total_trips")
