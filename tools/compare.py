"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

usage: python tools/compare.py [sf_dir] [name ...]

Rows are compared as exact multisets (both sides round floats inside the
query); set VOCALIS_COMPARE_DIGITS=5 to re-round for a looser look.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from vocalis.plans.queries import REGISTRY  # noqa: E402
from vocalis.session import build_session  # noqa: E402
from vocalis.sources.tables import TABLES  # noqa: E402


DIGITS = os.environ.get("VOCALIS_COMPARE_DIGITS")


def _r(v: float):
    return round(v, int(DIGITS)) if DIGITS else v


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return _r(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if hasattr(v, "__float__") and not isinstance(v, (int, bool)):
        return _r(float(v))
    return v


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(REGISTRY)
    spark = build_session("local[8]")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    bad = 0
    for n in names:
        q = REGISTRY[n]
        t0 = time.time()
        try:
            sdf = q.run(spark, sf)
            cols = sorted(sdf.columns)
            srows = [tuple(norm(r[c]) for c in cols) for r in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"{n:28s} SPARK-ERROR {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if not q.sql:
            print(f"{n:28s} rows-only {len(srows)} rows  {ts:.1f}s")
            continue
        try:
            rel = con.sql(q.sql)
            dcols = rel.columns
            drows_raw = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"{n:28s} DUCK-ERROR {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        if sorted(dcols) != cols:
            print(f"{n:28s} COLUMN MISMATCH spark={cols} duck={sorted(dcols)}")
            bad += 1
            continue
        idx = [dcols.index(c) for c in cols]
        drows = [tuple(norm(r[i]) for i in idx) for r in drows_raw]
        key = lambda r: tuple((x is None, str(x)) for x in r)
        ok = sorted(srows, key=key) == sorted(drows, key=key)
        if not ok:
            bad += 1
            ss, dd = sorted(srows, key=key), sorted(drows, key=key)
            diff = [(a, b) for a, b in zip(ss, dd) if a != b][:3]
            print(f"{n:28s} MISMATCH spark={len(srows)} duck={len(drows)} first diffs={diff}")
        else:
            print(f"{n:28s} OK {len(srows)} rows  {ts:.1f}s")
    print("bad:", bad)
    spark.stop()


if __name__ == "__main__":
    main()
