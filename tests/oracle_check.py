"""Run registered queries on Spark and their SQL twins on DuckDB; compare.

    python tests/oracle_check.py [key ...] [--sf DIR] [--all]

Prints one line per key: OK (exact), APPROX (equal within 1e-6 only),
or FAIL with the reason.  Compares sorted column names, row counts and the
multiset of rows (order-free), like the driver's correctness gate.
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import math
import os
import sys
import time
import traceback

import duckdb
import numpy as np
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tablekit.registry import TABLES  # noqa: E402


def norm(v, digits=None):
    if v is None:
        return None
    if isinstance(v, float) or isinstance(v, np.floating):
        f = float(v)
        if math.isnan(f):
            return None
        return round(f, digits) if digits is not None else f
    if isinstance(v, (np.integer,)):
        return int(v)
    if isinstance(v, (bool, np.bool_)):
        return bool(v)
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None).isoformat()
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(norm(x, digits) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x, digits)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return tuple(norm(x, digits) for x in v)
    if v is pd.NaT:
        return None
    try:
        if pd.isna(v):
            return None
    except (TypeError, ValueError):
        pass
    return v


def rows_of(df: pd.DataFrame, digits=None):
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].itertuples(index=False, name=None):
        out.append(tuple(norm(x, digits) for x in rec))
    return cols, sorted(out, key=repr)


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def check(spark, con, key, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    sp = sdf.toPandas()
    ts = time.time() - t0
    if sql is None:
        return f"ROWS   {key}: {len(sp)} rows (no SQL twin) [{ts:.1f}s]"
    od = con.execute(sql).df()
    sc, sr = rows_of(sp)
    oc, orr = rows_of(od)
    if sc != oc:
        return f"FAIL   {key}: columns spark={sc} oracle={oc}"
    if len(sr) != len(orr):
        return f"FAIL   {key}: rows spark={len(sr)} oracle={len(orr)}"
    if sr == orr:
        return f"OK     {key}: {len(sr)} rows [{ts:.1f}s]"
    _, sr6 = rows_of(sp, 6)
    _, or6 = rows_of(od, 6)
    if sr6 == or6:
        return f"APPROX {key}: {len(sr)} rows equal to 1e-6 only"
    diff = [(a, b) for a, b in zip(sr, orr) if a != b][:3]
    return f"FAIL   {key}: values differ, e.g. {diff}"


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("keys", nargs="*")
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    args = ap.parse_args()
    import __spark_entry__ as E
    from pyspark.sql import SparkSession
    # a plain session, like the driver's: no settings of our own
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    qs, sqls = E.queries(), E.oracle_sql()
    keys = args.keys or sorted(qs)
    con = duck(args.sf)
    bad = 0
    for k in keys:
        try:
            line = check(spark, con, k, qs[k], sqls.get(k), args.sf)
        except Exception as e:  # noqa: BLE001
            line = f"ERROR  {k}: {type(e).__name__}: {str(e)[:400]}"
            if os.environ.get("TRACE"):
                traceback.print_exc()
        if not line.startswith(("OK", "ROWS")):
            bad += 1
        print(line, flush=True)
    print(f"== {len(keys) - bad}/{len(keys)} ok")


if __name__ == "__main__":
    main()
