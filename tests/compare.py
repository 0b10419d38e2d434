"""Compare registered queries with their oracles, value by value.

    python tests/compare.py SF_DIR [name ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def canonical(value: object) -> str:
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "∅"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (float, decimal.Decimal)):
        return repr(float(value))
    if isinstance(value, int):
        return repr(value)
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    return str(value)


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(canonical(row[i]) for i in order) for row in rows)


def oracle_rows(sf_dir: str, sql: str) -> tuple[list[str], list[tuple]]:
    import duckdb

    con = duckdb.connect()
    for name in sorted(os.listdir(sf_dir)):
        if name.endswith(".parquet"):
            con.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM read_parquet('{sf_dir}/{name}')")
    cursor = con.execute(sql)
    return [d[0] for d in cursor.description], cursor.fetchall()


def compare(spark, sf_dir: str, name: str, fn, sql: str | None) -> str | None:
    """None when equal, else what differs. Without an oracle the rows are only counted."""
    df = fn(spark, sf_dir)
    ours = [tuple(r) for r in df.collect()]
    if sql is None:
        return None if ours else "no rows"
    columns, theirs = oracle_rows(sf_dir, sql)
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    a, b = rows_of(df.columns, ours), rows_of(columns, theirs)
    if not b:
        return "the oracle has no rows"
    if a == b:
        return None
    set_a, set_b = set(a), set(b)
    only_a = [r for r in a if r not in set_b][:3]
    only_b = [r for r in b if r not in set_a][:3]
    return f"{len(a)} rows != {len(b)} rows on {sorted(columns)}\n   spark: {only_a}\n   oracle: {only_b}"


def main() -> int:
    import __spark_entry__ as entry
    from ledgerloom.session import local_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            problem = compare(spark, sf_dir, name, queries[name], oracles.get(name))
        except Exception as error:  # the run goes on; the failure is counted and shown
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        mark = "ok  " if problem is None else "FAIL"
        kind = "" if name in oracles else " (no oracle)"
        print(f"{mark} {time.time() - start:6.2f}s {name}{kind}" + (f": {problem}" if problem else ""), flush=True)
        bad += problem is not None
    print(f"{bad} of {len(names or queries)} differ")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
