"""Compare a query with its SQL check: column names, types, row count and exact values."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}


def connect(sf_dir: str):
    from tabwright.plans.catalog import TABLES

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _key(row):
    return tuple((v is None, "" if v is None else repr(v)) for v in row)


def differences(df, con, sql: str) -> str | None:
    rel = con.sql(sql)
    ours = sorted(df.columns)
    theirs = sorted(rel.columns)
    if ours != theirs:
        return f"columns {ours} != {theirs}"
    types = dict(zip(rel.columns, map(str, rel.types)))
    for f in df.schema:
        if TYPES.get(f.dataType.simpleString()) != types[f.name]:
            return f"type of {f.name}: {f.dataType.simpleString()} != {types[f.name]}"
    a = [tuple(r[c] for c in ours) for r in df.collect()]
    at = [rel.columns.index(c) for c in ours]
    b = [tuple(r[i] for i in at) for r in rel.fetchall()]
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}"
    if not a:
        return "no rows on either side"
    wrong = [(x, y) for x, y in zip(sorted(a, key=_key), sorted(b, key=_key)) if x != y]
    if any(isinstance(v, float) and math.isnan(v) for r in a for v in r):
        return "NaN in the result"
    return f"{len(wrong)} rows differ in {ours}, first: {wrong[0][0]} != {wrong[0][1]}" if wrong else None


def main(names):
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as entry
    from tests.conftest import make_session

    spark = make_session()
    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    con = connect(sf)
    queries, oracles = entry.queries(), entry.oracle_sql()
    for name, fn in queries.items():
        if names and not any(name.startswith(n) for n in names):
            continue
        t = time.time()
        try:
            df = fn(spark, sf)
            if name in oracles:
                diff = differences(df, con, oracles[name])
                state = "ok" if diff is None else "DIFF " + diff
            else:
                state = f"rows only: {len(df.collect())}"
        except Exception as e:  # report and go on
            state = "ERROR " + str(e)[:600]
        print(f"{name:28s} {time.time() - t:6.1f}s {state}", flush=True)


if __name__ == "__main__":
    main(sys.argv[1:])
