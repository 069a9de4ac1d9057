"""Run catalogue queries in Spark and their SQL in DuckDB; compare results.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]

Floats are compared rounded to 6 decimals; with ORACLE_EXACT=1 they must be equal
bit-for-bit.  Column dtypes that differ between the engines are reported.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sillage.session import get_session  # noqa: E402
from sillage.sources.tables import TABLES  # noqa: E402


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v if os.environ.get("ORACLE_EXACT") else round(v, 6)
    if isinstance(v, pd.Timestamp):
        return v.tz_localize(None).isoformat() if v.tzinfo else v.isoformat()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if hasattr(v, "tolist"):
        return str(v.tolist())
    return v


def _kind(dtype) -> str:
    s = str(dtype)
    if s.startswith("datetime64"):
        return "datetime"
    return s


def frame_key(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    rows = [tuple(_norm(r[c]) for c in cols) for r in df.to_dict("records")]
    return sorted(rows, key=lambda t: tuple((x is None, str(x)) for x in t))


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir).toPandas()
    ts = time.time() - t0
    if sql is None:
        return f"{name}: rows={len(sdf)} (no oracle) {ts:.1f}s", True
    ddf = con.execute(sql).df()
    if sorted(sdf.columns) != sorted(ddf.columns):
        return f"{name}: COLUMNS spark={sorted(sdf.columns)} duck={sorted(ddf.columns)}", False
    if len(sdf) != len(ddf):
        return f"{name}: ROWS spark={len(sdf)} duck={len(ddf)}", False
    dt = [(c, str(sdf[c].dtype), str(ddf[c].dtype)) for c in sorted(sdf.columns)
          if _kind(sdf[c].dtype) != _kind(ddf[c].dtype)]
    if dt:
        print(f"  {name}: dtype differences {dt}")
    a, b = frame_key(sdf), frame_key(ddf)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{name}: VALUES {len(bad)} differ, e.g. {bad[0]}", False
    return f"{name}: OK rows={len(sdf)} {ts:.1f}s", True


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    import __spark_entry__ as entry

    spark = get_session("local[8]", 8)
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    ok_all = True
    for name in names or list(qs):
        try:
            msg, ok = compare(spark, con, name, qs[name], sqls.get(name), sf_dir)
        except Exception as e:  # report and go on
            msg, ok = f"{name}: ERROR {type(e).__name__}: {str(e)[:400]}", False
        ok_all &= ok
        print(msg, flush=True)
    print("ALL OK" if ok_all else "SOME FAILED")


if __name__ == "__main__":
    main()
