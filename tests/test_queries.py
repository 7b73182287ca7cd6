"""Every bound query against its SQL, and the shape of its plan."""

import re

import pytest

from bindings import QUERIES, SQL
from bindings.check import compare


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, sf_dir, database, key):
    df = QUERIES[key](spark, sf_dir)
    verdict, _ = compare(df, database, SQL[key])
    assert verdict == "same"
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    # nothing but the last step of a global aggregate runs in a single task
    lines = plan.splitlines()
    for above, line in zip(lines, lines[1:]):
        if "Exchange SinglePartition" in line:
            assert re.search(r"Aggregate\(key(s?)=\[\]|ShuffleQueryStage|AQEShuffleRead", above), line


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).limit(1).count() == 1
    assert set(QUERIES) <= set(entry.queries())
    assert set(SQL) <= set(entry.oracle_sql()) <= set(entry.queries())
