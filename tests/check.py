"""Compare registered queries with their DuckDB SQL: ``python tests/check.py [folder] [key ...]``."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SPARK_TO_DUCK = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "float": "FLOAT", "smallint": "SMALLINT",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def differences(spark, con, folder: str, key: str, queries, checks) -> str | None:
    """None when rows, names and types agree, else a short description."""
    df = queries[key](spark, folder)
    got_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    names = sorted(got_types)
    got = sorted(([_plain(r[n]) for n in names] for r in df.collect()), key=repr)
    if key not in checks:
        return None if names else "no columns"
    rel = con.sql(checks[key])
    want_types = dict(zip(rel.columns, [str(x) for x in rel.types]))
    if sorted(want_types) != names:
        return f"columns {names} != {sorted(want_types)}"
    bad = {n: (got_types[n], want_types[n]) for n in names if SPARK_TO_DUCK.get(got_types[n]) != want_types[n]}
    if bad:
        return f"types {bad}"
    order = [rel.columns.index(n) for n in names]
    want = sorted(([_plain(r[i]) for i in order] for r in rel.fetchall()), key=repr)
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}; e.g. {next((x for x in got if x not in want[:2000]), None) if len(got) < 3000 else ''}"
    for a, b in zip(got, want):
        if a != b:
            return f"{names}\n  got  {a}\n  want {b}"
    return None if got else "empty result"


if __name__ == "__main__":
    from flowloom.plans.queries import CHECKS, QUERIES
    from flowloom.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or list(QUERIES)
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    for key in keys:
        start = time.time()
        try:
            problem = differences(spark, con, folder, key, QUERIES, CHECKS)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        failed += problem is not None
        mark = "ok" if problem is None else "BAD"
        print(f"{mark:4}{key:28}{time.time() - start:6.1f}s  {'' if key in CHECKS else '(rows only)'} {problem or ''}", flush=True)
    print(f"{len(keys) - failed} of {len(keys)} agree")
    spark.stop()
