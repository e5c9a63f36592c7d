"""Runs registered queries next to their SQL and compares schema, rows and values."""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _kind(value):
    return type(value).__name__


def compare(spark, connection, name: str, sf_dir: str) -> str:
    """Empty when equal, else what differs. Types count: 1 and 1.0 are different."""
    from __spark_entry__ import oracle_sql, queries

    frame = queries()[name](spark, sf_dir)
    columns = sorted(frame.columns)
    left = [tuple(row[c] for c in columns) for row in frame.collect()]
    result = connection.execute(oracle_sql()[name])
    names = [d[0] for d in result.description]
    if sorted(names) != columns:
        return f"columns differ: {columns} and {sorted(names)}"
    places = [names.index(c) for c in columns]
    right = [tuple(row[i] for i in places) for row in result.fetchall()]
    if not left and not right:
        return "both sides are empty"
    a, b = (Counter(tuple((_kind(v), v) for v in row) for row in rows) for rows in (left, right))
    if a == b:
        return ""
    only_a, only_b = list((a - b).elements()), list((b - a).elements())
    show = lambda rows: sorted([tuple(v for _, v in r) for r in rows], key=repr)[:2]
    return f"{len(left)} and {len(right)} rows, {len(only_a)} and {len(only_b)} differ\n  spark {show(only_a)}\n  sql   {show(only_b)}"


def main(names: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries

    from tidegate.session import local_session

    sf_dir = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
    spark, connection, bad = local_session(), connect(sf_dir), 0
    for name in names or list(queries()):
        started = time.time()
        try:
            if name in oracle_sql():
                problem = compare(spark, connection, name, sf_dir)
            else:
                rows = queries()[name](spark, sf_dir).collect()
                problem = "" if rows else "no rows"
                name = f"{name} ({len(rows)} rows only)"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(problem)
        print(f"{'ok  ' if not problem else 'FAIL'} {time.time() - started:6.2f}s {name} {problem}", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    sys.exit(1 if main(sys.argv[1:]) else 0)
