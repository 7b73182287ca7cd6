"""Constraint checks on lineitem, orders and customer."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.registry import bind, table
from dockwise.operators import quality as q


@bind(
    "check_not_null",
    """
    SELECT 'c_custkey' AS "column", count(*) - count(c_custkey) AS nulls FROM customer
    UNION ALL SELECT 'balance', count(*) FILTER (c_acctbal <= 0) FROM customer
    """,
)
def check_not_null(spark, sf):
    rows = table(spark, sf, "customer").withColumn(
        "balance", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal"))
    )
    return q.check_not_null(rows, ["c_custkey", "balance"])


@bind(
    "check_domain",
    """
    SELECT count(*) AS total, count(*) FILTER (l_returnflag NOT IN ('A', 'N')) AS violations
    FROM lineitem
    """,
)
def check_domain(spark, sf):
    return q.check_domain(table(spark, sf, "lineitem"), "l_returnflag", ["A", "N"])


@bind(
    "check_unique",
    "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
def check_unique(spark, sf):
    return q.check_unique(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@bind(
    "check_foreign_key",
    """
    SELECT l_partkey, count(*) AS n FROM lineitem
    WHERE l_partkey NOT IN (SELECT s_suppkey FROM supplier) GROUP BY ALL
    """,
)
def check_foreign_key(spark, sf):
    return q.check_foreign_key(
        table(spark, sf, "lineitem"), table(spark, sf, "supplier"), "l_partkey", "s_suppkey"
    )


@bind(
    "check_row_limit",
    "SELECT count(*) AS row_count, count(*) = 10000 AS limit_reached FROM events",
)
def check_row_limit(spark, sf):
    return q.check_row_limit(table(spark, sf, "events"), 10000)
