"""Compare queries with their SQL: `python -m bindings.check <sf_dir> [key ...]`."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "float": "FLOAT",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "array<string>": "VARCHAR[]",
}


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _key(row: tuple) -> tuple:
    return tuple((value is not None, str(value)) for value in row)


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def compare(df, con, statement: str) -> tuple[str, int]:
    """`same`, `close` (floats differ by at most 1e-9) or what differs; and the row count."""
    result = con.execute(statement)
    names = [d[0] for d in result.description]
    types = dict(zip(names, [str(d[1]) for d in result.description]))
    want = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}", len(want)
    kinds = {n: TYPES.get(t, t) for n, t in df.dtypes}
    con_types = dict(
        zip(names, [str(t) for t in con.sql(statement).types])
    )
    wrong = {n: (kinds[n], con_types[n]) for n in names if kinds[n] != con_types[n]}
    order = sorted(names)
    got = [tuple(_plain(r[n]) for n in order) for r in df.collect()]
    at = [names.index(n) for n in order]
    want = [tuple(_plain(r[i]) for i in at) for r in want]
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}", len(want)
    got.sort(key=_key)
    want.sort(key=_key)
    if got == want:
        return ("same" if not wrong else f"types {wrong}"), len(want)
    # floats that differ in the last digits can change the text order
    def rounded(row):
        return tuple(float(f"{v:.9g}") if isinstance(v, float) else v for v in row)

    got, want = (sorted(map(rounded, rows), key=_key) for rows in (got, want))
    if got == want:
        return "close", len(want)
    bad = [(a, b) for a, b in zip(got, want) if a != b]
    return f"{len(bad)} rows differ, first {order}: {bad[0]} {wrong or ''}", len(want)


def main(argv: list[str]) -> int:
    from bindings import QUERIES, SQL
    from dockwise.session import local_session

    sf_dir, keys = argv[0], argv[1:] or list(QUERIES)
    spark = local_session(8)
    con = database(sf_dir)
    failures = 0
    for key in keys:
        begin = time.time()
        try:
            df = QUERIES[key](spark, sf_dir)
            if key in SQL:
                verdict, rows = compare(df, con, SQL[key])
            else:
                verdict, rows = "no sql", df.count()
        except Exception as error:
            verdict, rows = f"{type(error).__name__}: {str(error)[:600]}", -1
        failures += verdict not in ("same", "no sql")
        print(f"{key:28s} {rows:8d} {time.time() - begin:6.1f}s  {verdict}", flush=True)
    print(f"{len(keys)} queries, {failures} not the same")
    return failures


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
