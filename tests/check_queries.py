"""Run named queries and their SQL on one data folder and compare the rows.

Usage: python tests/check_queries.py [folder] [name part ...]
"""

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from lograil.session import local_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    """A comparable form of a value: numbers by value, everything else as text."""
    if value is None:
        return ("0", "")
    if isinstance(value, bool):
        return ("b", str(value))
    if isinstance(value, (int, float)):
        return ("n", repr(round(float(value), 9)))
    return ("t", str(value))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, name, folder):
    """(problem or None, seconds, rows)"""
    started = time.time()
    df = entry.queries()[name](spark, folder)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    seconds = time.time() - started
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return (None if got[1] else "no rows"), seconds, len(got[1])
    result = con.execute(sql)
    want = rows_of([d[0] for d in result.description], result.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} expected {want[0]}", seconds, len(got[1])
    if got[1] != want[1]:
        extra = [r for r in got[1] if r not in set(want[1])][:2]
        missing = [r for r in want[1] if r not in set(got[1])][:2]
        return (f"{len(got[1])} rows, expected {len(want[1])}\n  got  {extra}\n  want {missing}",
                seconds, len(got[1]))
    if not got[1]:
        return "no rows on either side", seconds, 0
    return None, seconds, len(got[1])


def main():
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    parts = sys.argv[2:]
    spark, con = local_session("check"), connect(folder)
    bad = 0
    for name in entry.queries():
        if parts and not any(p in name for p in parts):
            continue
        try:
            problem, seconds, count = compare(spark, con, name, folder)
        except Exception as error:  # noqa: BLE001
            problem, seconds, count = f"{type(error).__name__}: {str(error)[:900]}", 0, 0
        oracle = "" if name in entry.oracle_sql() else " (rows only)"
        print(f"{'ok  ' if problem is None else 'FAIL'} {name:32} {seconds:6.2f}s {count:7}{oracle}")
        if problem:
            bad += 1
            print("   ", problem)
    print("failed:", bad)


if __name__ == "__main__":
    main()
