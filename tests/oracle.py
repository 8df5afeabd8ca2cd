"""Run registered queries and their SQL side by side: python tests/oracle.py SF [name …]"""

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def compare(spark, con, name, sf_dir):
    """(problem or None, number of rows, seconds in Spark)."""
    from tomeworks.plans.registered import ORACLES, QUERIES

    began = time.time()
    df = QUERIES[name](spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    took = time.time() - began
    if name not in ORACLES:
        return (None if got[1] else "no rows"), len(got[1]), took
    cursor = con.execute(ORACLES[name])
    want = rows_of([c[0] for c in cursor.description], cursor.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} but {want[0]}", len(got[1]), took
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows but {len(want[1])}", len(got[1]), took
    off = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
    return (f"{len(off)} rows differ, first {off[0]}" if off else None), len(got[1]), took


if __name__ == "__main__":
    from tomeworks.plans.registered import QUERIES
    from tomeworks.session import local_session

    folder = f"/root/testdata/{sys.argv[1]}"
    session, db = local_session("oracle", "8"), connect(folder)
    for query in sys.argv[2:] or QUERIES:
        try:
            problem, n, seconds = compare(session, db, query, folder)
        except Exception as err:  # noqa: BLE001 - report every query
            problem, n, seconds = f"{type(err).__name__}: {str(err)[:400]}", 0, 0
        print(f"{'ok  ' if problem is None else 'BAD '} {query:24} {n:7} rows {seconds:6.2f}s {problem or ''}", flush=True)
