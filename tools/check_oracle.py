"""Run catalog queries in Spark and their oracle SQL in DuckDB, and compare.

    python tools/check_oracle.py [sf_dir] [name-prefix ...]

Compares row count, column names and the multiset of rows (floats to 9 significant
digits).  Prints one line per query and a summary.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from ledgerline.plans import catalog  # noqa: E402
from ledgerline.session import local_session  # noqa: E402
from ledgerline.sources.tables import TEST_TABLES  # noqa: E402


def norm(v):
    if v is None:
        return ("~null",)
    if isinstance(v, float):
        if math.isnan(v):
            return ("~nan",)
        return ("f", float(f"{v:.9g}"))
    if hasattr(v, "is_finite"):  # Decimal
        return ("f", float(f"{float(v):.9g}"))
    if isinstance(v, bool):
        return ("i", int(v))
    if isinstance(v, int):
        return ("f", float(f"{v:.9g}")) if abs(v) > 2**53 else ("i", v)
    if isinstance(v, (list, tuple)):
        return ("l", tuple(norm(x) for x in v))
    if hasattr(v, "isoformat"):
        return ("t", v.isoformat())
    return ("s", str(v))


def main():
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    prefixes = [a for a in args if not a.startswith("/")]
    spark = local_session()
    con = duckdb.connect()
    for t in TEST_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    qs = catalog.queries()
    sql = catalog.oracle_sql()
    ok = bad = nosql = 0
    for name, fn in qs.items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf)
            rows = [tuple(r) for r in df.collect()]
            cols = df.columns
        except Exception as e:  # noqa: BLE001
            print(f"ERROR spark {name}: {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        dt = time.time() - t0
        if name not in sql:
            print(f"nosql {name}: {len(rows)} rows {dt:.1f}s")
            nosql += 1
            continue
        try:
            cur = con.execute(sql[name])
            orows = cur.fetchall()
            ocols = [d[0] for d in cur.description]
        except Exception as e:  # noqa: BLE001
            print(f"ERROR duckdb {name}: {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        msgs = []
        if sorted(cols) != sorted(ocols):
            msgs.append(f"cols spark={cols} duck={ocols}")
        if len(rows) != len(orows):
            msgs.append(f"rows spark={len(rows)} duck={len(orows)}")
        if not msgs:
            order = sorted(range(len(cols)), key=lambda i: cols[i])
            oorder = sorted(range(len(ocols)), key=lambda i: ocols[i])
            a = sorted(tuple(norm(r[i]) for i in order) for r in rows)
            b = sorted(tuple(norm(r[i]) for i in oorder) for r in orows)
            if a != b:
                diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
                msgs.append(f"values differ, e.g. {diff}")
        if msgs:
            bad += 1
            print(f"FAIL {name} ({dt:.1f}s): " + "; ".join(msgs))
        else:
            ok += 1
            print(f"ok   {name}: {len(rows)} rows {dt:.1f}s")
    print(f"SUMMARY ok={ok} fail={bad} nosql={nosql}")
    spark.stop()


if __name__ == "__main__":
    main()
