"""Run registered queries on Spark and their oracle SQL on DuckDB; compare.

Usage: python tools/oracle_check.py [--sf DIR] [key-substring ...]

Reports per key: row counts, column names, and whether the order-insensitive
multiset of rows matches exactly, or only after rounding floats to 9
significant digits.  Keys without an oracle get a row count only.
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import json
import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v, approx: bool):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}") if approx else v
    if isinstance(v, decimal.Decimal):
        return norm(float(v), approx)
    if isinstance(v, bool):
        return v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x, approx) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((str(k), str(norm(x, approx))) for k, x in v.items()))
    return v


def rows_key(rows, approx):
    return sorted((tuple(norm(v, approx) for v in r) for r in rows), key=repr)


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--out", default=None)
    ap.add_argument("--partitions", type=int, default=8)
    ap.add_argument("--tz", default="UTC")
    ap.add_argument("keys", nargs="*")
    a = ap.parse_args()

    import duckdb

    from tillpoint.catalog.registry import ORACLES, QUERIES, load_all
    from tillpoint.session import local_session

    load_all()
    spark = local_session(8, shuffle_partitions=a.partitions, extra={"spark.sql.session.timeZone": a.tz})
    con = duckdb.connect()
    for t in TABLES:
        p = f"{a.sf}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")

    keys = [k for k in QUERIES if not a.keys or any(s in k for s in a.keys)]
    report = {}
    bad = 0
    for k in keys:
        rec = {}
        t0 = time.time()
        try:
            sdf = QUERIES[k](spark, a.sf)
            cols = sdf.columns
            srows = [tuple(r) for r in sdf.collect()]
            rec["spark_rows"] = len(srows)
            rec["spark_sec"] = round(time.time() - t0, 2)
            if k in ORACLES:
                res = con.execute(ORACLES[k])
                ocols = [d[0] for d in res.description]
                orows = res.fetchall()
                rec["oracle_rows"] = len(orows)
                if sorted(cols) != sorted(ocols):
                    rec["status"] = "COLUMNS"
                    rec["spark_only"] = sorted(set(cols) - set(ocols))
                    rec["oracle_only"] = sorted(set(ocols) - set(cols))
                else:
                    order = sorted(cols)
                    si = [cols.index(c) for c in order]
                    oi = [ocols.index(c) for c in order]
                    s2 = [tuple(r[i] for i in si) for r in srows]
                    o2 = [tuple(r[i] for i in oi) for r in orows]
                    if rows_key(s2, False) == rows_key(o2, False):
                        rec["status"] = "EXACT"
                    elif rows_key(s2, True) == rows_key(o2, True):
                        rec["status"] = "APPROX"
                    else:
                        rec["status"] = "MISMATCH"
                        ss, oo = rows_key(s2, True), rows_key(o2, True)
                        diff_s = sorted(set(ss) - set(oo), key=repr)[:3]
                        diff_o = sorted(set(oo) - set(ss), key=repr)[:3]
                        rec["cols"] = order
                        rec["spark_example"] = [repr(x) for x in diff_s]
                        rec["oracle_example"] = [repr(x) for x in diff_o]
                    rec["types"] = {c: (str(sdf.schema[c].dataType.simpleString()),
                                        str(res.description[ocols.index(c)][1])) for c in order}
            else:
                rec["status"] = "ROWS_ONLY"
        except Exception as e:  # noqa: BLE001
            rec["status"] = "ERROR"
            rec["error"] = "".join(traceback.format_exception_only(type(e), e))[-1500:]
        if rec["status"] not in ("EXACT", "APPROX", "ROWS_ONLY"):
            bad += 1
        report[k] = rec
        short = {x: rec[x] for x in rec if x not in ("types",)}
        print(k, json.dumps(short, default=str)[:1500], flush=True)
    if a.out:
        with open(a.out, "w") as f:
            json.dump(report, f, indent=1, default=str)
    print(f"checked {len(keys)}; problems {bad}")
    return 0 if bad == 0 else 1


if __name__ == "__main__":
    raise SystemExit(main())
