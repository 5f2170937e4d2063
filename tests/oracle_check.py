"""Run registered queries in Spark and their SQL in DuckDB; compare.

    python tests/oracle_check.py [sf_dir] [key ...]

Comparison mirrors the driver's: columns sorted by name, row count, and an
order-insensitive multiset of rows.  Floats are compared exactly first; a
second, tolerant pass (1e-9 relative) is reported separately.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

from lakeline.plans.registry import load_all  # noqa: E402
from lakeline.plans.tables import TABLE_NAMES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, tol: bool):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(f"{v:.9g}") if tol else v
    if isinstance(v, decimal.Decimal):
        return _norm(float(v), tol)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (dt.date,)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, tol) for x in v)
    if hasattr(v, "item"):
        return _norm(v.item(), tol)
    return v


def rows_of(cols, rows, tol):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i], tol) for i in order) for r in rows)


def compare(spark, con, key, q, sf_dir):
    t0 = time.time()
    sdf = q(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    res = con.execute(q.sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    out = {"key": key, "spark_rows": len(srows), "duck_rows": len(drows), "sec": round(t1 - t0, 2)}
    out["cols_match"] = sorted(scols) == sorted(dcols)
    if not out["cols_match"]:
        out["cols"] = (sorted(scols), sorted(dcols))
        return out
    out["exact"] = rows_of(scols, srows, False) == rows_of(dcols, drows, False)
    out["tolerant"] = rows_of(scols, srows, True) == rows_of(dcols, drows, True)
    if not out["tolerant"]:
        a, b = rows_of(scols, srows, True), rows_of(dcols, drows, True)
        out["only_spark"] = list((a - b).items())[:3]
        out["only_duck"] = list((b - a).items())[:3]
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    keys = [a for a in argv[1:] if not a.startswith("/")]
    from lakeline.session import build_session

    spark = build_session()
    con = duck(sf_dir)
    reg = load_all()
    bad = 0
    for k, q in reg.items():
        if keys and k not in keys:
            continue
        if q.sql is None:
            t0 = time.time()
            n = q(spark, sf_dir).count()
            print({"key": k, "rows_only": n, "sec": round(time.time() - t0, 2)}, flush=True)
            continue
        try:
            r = compare(spark, con, k, q, sf_dir)
        except Exception as e:  # report and go on
            r = {"key": k, "error": repr(e)[:800]}
        ok = r.get("exact") and r.get("spark_rows") == r.get("duck_rows")
        bad += not ok
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    print(f"done, {bad} not exact")


if __name__ == "__main__":
    main(sys.argv)
