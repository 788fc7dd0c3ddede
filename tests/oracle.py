"""Run registered queries and compare them with DuckDB on the same files.

``python -m tests.oracle [sf_dir] [query ...]`` prints one line per query.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time
import traceback

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        path = f"{folder}/{name}.parquet"
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{files}')")
    return con


def normal(value):
    """One form per value: numbers as rounded floats or ints, dates and times as text."""
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.10g}")
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value.isoformat() if isinstance(value, dt.date) else value


KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def compare(spark, con, function, sql: str, folder: str) -> str | None:
    """None when equal, otherwise what differs."""
    df = function(spark, folder)
    columns = sorted(df.columns)
    mine = sorted((tuple(normal(row[c]) for c in columns) for row in df.collect()), key=repr)
    described = {row[0]: row[1] for row in con.execute(f"DESCRIBE {sql}").fetchall()}
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != columns:
        return f"columns {columns} against {sorted(names)}"
    order = [names.index(c) for c in columns]
    theirs = sorted((tuple(normal(row[i]) for i in order) for row in cursor.fetchall()), key=repr)
    if len(mine) != len(theirs):
        return f"{len(mine)} rows against {len(theirs)}"
    for a, b in zip(mine, theirs):
        if a != b:
            return f"{dict(zip(columns, a))} against {dict(zip(columns, b))}"
    if not mine:
        return "no rows on either side"
    kinds = {c: (KINDS.get(t, t), described[c]) for c, t in df.dtypes}
    wrong = {c: k for c, k in kinds.items() if k[0] != k[1]}
    return f"types {wrong}" if wrong else None


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from eventloom import get_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = get_session("oracle", master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, failed = connect(folder), oracle_sql(), 0
    for name, function in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in oracles:
                problem = compare(spark, con, function, oracles[name], folder)
            else:
                problem = None if function(spark, folder).count() else "no rows"
        except Exception:
            problem = traceback.format_exc()[-1500:]
        failed += problem is not None
        print(f"{name:32s} {time.time() - start:6.2f}s  {problem or 'ok'}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main())
