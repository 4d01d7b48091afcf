"""Run registered queries in Spark and their oracles in DuckDB, compare.

Usage: python tests/oracle_check.py [--sf DIR] [name-prefix ...]
Compares row count, column names, and the order-insensitive multiset of rows
(columns sorted by name; doubles compared after rounding to 6 digits).
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck_conn(sf_dir):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        r = round(v, 6)
        return 0.0 if r == 0 else r
    if hasattr(v, "item"):
        return norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    names = [cols[i] for i in order]
    out = sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)
    return names, out


def compare(spark, name, fn, sql, sf_dir, con):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    if sql is None:
        return dict(name=name, ok=None, rows=len(srows), spark_s=round(t1 - t0, 2), note="no oracle")
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    t2 = time.time()
    sn, sr = canon(scols, srows)
    dn, dr = canon(dcols, drows)
    ok = sn == dn and sr == dr
    note = ""
    if sn != dn:
        note = f"cols spark={sn} duck={dn}"
    elif len(sr) != len(dr):
        note = f"rows spark={len(sr)} duck={len(dr)}"
    elif sr != dr:
        bad = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
        note = f"values differ, e.g. {bad}"
    return dict(name=name, ok=ok, rows=len(srows), spark_s=round(t1 - t0, 2), duck_s=round(t2 - t1, 2), note=note)


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()
    from zonekit.session import get_spark
    import __spark_entry__ as E
    spark = get_spark("local[8]", 8, driver_memory="16g")
    qs, ors = E.queries(), E.oracle_sql()
    con = duck_conn(a.sf)
    names = [n for n in qs if not a.names or any(n.startswith(p) for p in a.names)]
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, qs[n], ors.get(n), a.sf, con)
        except Exception as e:  # report and continue
            r = dict(name=n, ok=False, note=f"ERROR {type(e).__name__}: {str(e)[:300]}")
        if r.get("ok") is False:
            bad += 1
        print(r, flush=True)
    print(f"checked {len(names)}, failed {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
