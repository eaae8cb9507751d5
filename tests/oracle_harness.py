"""Run catalog queries on Spark and their SQL on DuckDB and compare (names, rows, values).

    python tests/oracle_harness.py [sf_dir] [name ...]
"""
from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) + 0.0
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def canon(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    rows = [tuple(_norm(x) for x in r) for r in df[cols].astype(object).itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark, con, name, fn, sql, sf_dir, verbose=True):
    t0 = time.time()
    s = fn(spark, sf_dir).toPandas()
    t1 = time.time()
    if sql is None:
        return {"name": name, "ok": None, "rows": len(s), "spark_sec": round(t1 - t0, 2)}
    o = con.execute(sql).df()
    res = {"name": name, "rows": len(s), "oracle_rows": len(o), "spark_sec": round(t1 - t0, 2)}
    if sorted(s.columns) != sorted(o.columns):
        res.update(ok=False, why=f"columns {sorted(s.columns)} vs {sorted(o.columns)}")
        return res
    a, b = canon(s), canon(o)
    if a == b:
        res["ok"] = True
        return res
    bad = [(x, y) for x, y in zip(a, b) if x != y][:3]
    res.update(ok=False, why=f"rows {len(a)} vs {len(b)}; first diffs {bad}")
    return res


def main():
    from stratum.session import get_session
    from stratum.plans.catalog import REGISTRY
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(REGISTRY)
    spark = get_session("local[8]", 8)
    con = duck(sf_dir)
    bad = 0
    for n in names:
        fn, sql = REGISTRY[n]
        try:
            r = compare(spark, con, n, fn, sql, sf_dir)
        except Exception as e:  # report and continue
            r = {"name": n, "ok": False, "why": f"{type(e).__name__}: {str(e)[:600]}"}
        bad += r.get("ok") is False
        print(r, flush=True)
    print(f"{len(names) - bad}/{len(names)} ok or rows-only")


if __name__ == "__main__":
    main()
