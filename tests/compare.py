"""Spark query vs DuckDB oracle comparison (what the correctness gate does).

Usage: python tests/compare.py SF_DIR [query ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        return v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _key(row):
    return tuple((x is None, str(type(x).__name__) if x is not None else "", x if x is not None else 0) for x in row)


def rows_of(cols, rows, order):
    idx = [cols.index(c) for c in order]
    out = [tuple(_norm(r[i]) for i in idx) for r in rows]
    out.sort(key=lambda r: tuple((x is None, str(x)) for x in r))
    return out


#: Spark type -> DuckDB type.
KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE",
}


def compare(spark, con, name: str, spark_df, sql: str, verbose: bool = True) -> dict:
    t0 = time.time()
    s_rows = [tuple(r) for r in spark_df.collect()]
    s_cols = list(spark_df.columns)
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    t2 = time.time()
    out = {"name": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "spark_sec": round(t1 - t0, 2), "oracle_sec": round(t2 - t1, 2)}
    if sorted(s_cols) != sorted(d_cols):
        out["status"] = "COLUMNS"
        out["detail"] = f"spark-only {sorted(set(s_cols) - set(d_cols))} oracle-only {sorted(set(d_cols) - set(s_cols))}"
        return out
    kinds = {c: KINDS.get(t, t) for c, t in spark_df.dtypes}
    unlike = {d[0]: (kinds[d[0]], str(d[1])) for d in res.description if kinds[d[0]] != str(d[1])}
    if unlike:
        out["status"] = "TYPES"
        out["detail"] = unlike
        return out
    order = sorted(s_cols)
    a = rows_of(s_cols, s_rows, order)
    b = rows_of(d_cols, d_rows, order)
    if a == b:
        out["status"] = "MATCH"
        return out
    out["status"] = "DIFF"
    sa, sb = set(a), set(b)
    only_s = [r for r in a if r not in sb][:3]
    only_d = [r for r in b if r not in sa][:3]
    out["detail"] = {"cols": order, "spark_only": only_s, "oracle_only": only_d,
                     "n_spark_only": sum(1 for r in a if r not in sb),
                     "n_oracle_only": sum(1 for r in b if r not in sa)}
    return out


def main(argv):
    sf_dir = argv[1]
    names = argv[2:]
    from recurra.plans.oracle import oracle_sql
    from recurra.plans.queries import QUERIES
    from recurra.session import build_session

    spark = build_session("local[8]", 8)
    con = duck(sf_dir)
    sqls = oracle_sql()
    names = names or list(QUERIES)
    bad = 0
    for n in names:
        try:
            r = compare(spark, con, n, QUERIES[n](spark, sf_dir), sqls[n])
        except Exception as e:  # report and continue
            r = {"name": n, "status": "ERROR", "detail": f"{type(e).__name__}: {str(e)[:800]}"}
        bad += r["status"] != "MATCH"
        print(r, flush=True)
    print("FAILED" if bad else "ALL MATCH", bad)


if __name__ == "__main__":
    main(sys.argv)
