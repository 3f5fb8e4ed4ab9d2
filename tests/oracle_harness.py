"""Run registered queries against their DuckDB oracle, like the driver's check.

Usage: python tests/oracle_harness.py [sf_dir] [name-prefix ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(f"{v:.9g}")
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:
            return v
    if isinstance(v, pd.Timestamp):
        return v.date().isoformat() if v.hour == 0 and v.minute == 0 and v.second == 0 else v.isoformat()
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10] if type(v).__name__ == "date" else v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def canon(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    rows = [tuple(_norm(v) for v in row) for row in pdf[cols].itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def close(a, b) -> bool:
    if a == b:
        return True
    if isinstance(a, float) and isinstance(b, (float, int)) or isinstance(b, float) and isinstance(a, (float, int)):
        return abs(a - b) <= 1e-7 * max(1.0, abs(a), abs(b))
    if isinstance(a, tuple) and isinstance(b, tuple) and len(a) == len(b):
        return all(close(x, y) for x, y in zip(a, b))
    return False


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    spdf = sdf.toPandas()
    t1 = time.time()
    res = {"name": name, "spark_rows": len(spdf), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    opdf = con.execute(sql).df()
    res["oracle_rows"] = len(opdf)
    if sorted(spdf.columns) != sorted(opdf.columns):
        res["status"] = "SCHEMA"
        res["detail"] = f"spark={sorted(spdf.columns)} oracle={sorted(opdf.columns)}"
        return res
    a, b = canon(spdf), canon(opdf)
    if len(a) != len(b):
        res["status"] = "ROWCOUNT"
        return res
    bad = [(x, y) for x, y in zip(a, b) if not close(x, y)]
    if bad:
        res["status"] = "VALUES"
        cols = sorted(spdf.columns)
        x, y = bad[0]
        diffs = [(c, p, q) for c, p, q in zip(cols, x, y) if not close(p, q)]
        res["detail"] = f"{len(bad)} rows differ; first: {diffs[:6]}"
        return res
    res["status"] = "OK"
    return res


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = sys.argv[2:]
    import __spark_entry__ as E
    from stayrisk.session import local_session

    spark = local_session(8)
    con = duck(sf_dir)
    qs, oracle = E.queries(), E.oracle_sql()
    summary = {}
    for name, fn in qs.items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        try:
            r = compare(spark, con, name, fn, oracle.get(name), sf_dir)
        except Exception as exc:  # report and continue
            r = {"name": name, "status": "ERROR", "detail": repr(exc)[:600]}
        summary[r["status"]] = summary.get(r["status"], 0) + 1
        print(r, flush=True)
    print("SUMMARY", summary)


if __name__ == "__main__":
    main()
