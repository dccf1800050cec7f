"""Run registered queries beside their SQL and report differences.

Usage: python tests/check_oracle.py [sf] [name ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from shelfwise.session import local_session  # noqa: E402

QUERIES, ORACLES = queries(), oracle_sql()

NAMES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def duck(folder: str):
    connection = duckdb.connect()
    for name in NAMES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def rows_of(records, columns):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(tuple(repr(r[k]) for k in order) for r in records)


def compare(spark, connection, name: str, folder: str) -> str:
    start = time.time()
    df = QUERIES[name](spark, folder)
    got = [tuple(r) for r in df.collect()]
    took = time.time() - start
    if name not in ORACLES:
        return f"ok   {name}: {len(got)} rows, no SQL, {took:.2f}s"
    cursor = connection.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    want = cursor.fetchall()
    if sorted(columns) != sorted(df.columns):
        return f"FAIL {name}: columns {sorted(df.columns)} vs {sorted(columns)}"
    mine, theirs = rows_of(got, df.columns), rows_of(want, columns)
    pairs = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "int": "INTEGER", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}
    odd = [(c, k, kinds[c]) for c, k in df.dtypes if pairs.get(k, k) != kinds[c]]
    note = f" types differ {odd}" if odd else ""
    if mine != theirs:
        ours, others = set(mine), set(theirs)
        left, right = sorted(ours - others)[:3], sorted(others - ours)[:3]
        return f"FAIL {name}: {len(mine)} vs {len(theirs)} rows{note}\n  spark {left}\n  sql   {right}"
    return f"{'FAIL' if odd else 'ok  '} {name}: {len(mine)} rows, {took:.2f}s{note}"


if __name__ == "__main__":
    scale = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    folder = f"/root/testdata/sf{scale}"
    session, connection = local_session(), duck(folder)
    for wanted in sys.argv[2:] or list(QUERIES):
        try:
            print(compare(session, connection, wanted, folder), flush=True)
        except Exception as error:  # report and go on to the next query
            print(f"FAIL {wanted}: {type(error).__name__} {str(error)[:1500]}", flush=True)
