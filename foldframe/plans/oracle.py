"""Run a registered query on Spark and its SQL on DuckDB, and compare.

Used by the tests and by hand: ``python -m foldframe.plans.oracle [sf_dir] [key ...]``.
Comparison is order-insensitive; doubles are compared after rounding.
"""
from __future__ import annotations

import math
import sys
import time

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir.rstrip('/')}/{t}.parquet')")
    return con


def _norm(v, digits=6):
    import pandas as pd

    if v is None or v is pd.NA or v is pd.NaT:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        r = round(v, digits)
        if r == int(r) and abs(r) < 2 ** 53:
            return (1, str(int(r)))
        return (1, repr(r))
    if hasattr(v, "item"):
        return _norm(v.item(), digits)
    return (1, str(v))


def rows_of(pdf):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(None if (isinstance(x, float) and math.isnan(x)) else x) for x in rec))
    out.sort()
    return cols, out


def compare(spark, key: str, sf_dir: str, con=None, show: int = 5) -> dict:
    from .registry import all_queries, all_sql

    q = all_queries()[key]
    sql = all_sql().get(key)
    t0 = time.time()
    sdf = q(spark, sf_dir).toPandas()
    t1 = time.time()
    res = {"key": key, "spark_rows": len(sdf), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["oracle"] = "none"
        return res
    con = con or duck(sf_dir)
    ddf = con.execute(sql).df()
    res["oracle_rows"] = len(ddf)
    sc, sr = rows_of(sdf)
    dc, dr = rows_of(ddf)
    res["cols_equal"] = sc == dc
    res["equal"] = sc == dc and sr == dr
    if not res["equal"]:
        res["spark_cols"], res["oracle_cols"] = sc, dc
        ss, ds = set(sr), set(dr)
        res["only_spark"] = [r for r in sr if r not in ds][:show]
        res["only_oracle"] = [r for r in dr if r not in ss][:show]
    return res


def main(argv):
    from ..session import get_session
    from .registry import all_queries

    sf_dir = "/root/testdata/sf0.01"
    keys = []
    for a in argv:
        if a.startswith("/"):
            sf_dir = a
        else:
            keys.append(a)
    spark = get_session("local[8]")
    keys = keys or sorted(all_queries())
    con = duck(sf_dir)
    bad = 0
    for k in keys:
        try:
            r = compare(spark, k, sf_dir, con)
        except Exception as e:  # report and go on
            r = {"key": k, "error": repr(e)[:2000]}
        ok = r.get("equal", r.get("oracle") == "none" and "error" not in r)
        bad += 0 if ok else 1
        print(("OK   " if ok else "FAIL ") + str(r), flush=True)
    print(f"{len(keys) - bad}/{len(keys)} ok")


if __name__ == "__main__":
    main(sys.argv[1:])
