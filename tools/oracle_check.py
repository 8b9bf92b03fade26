"""Compare each Spark query with its DuckDB oracle on one input directory:
row count, column names and an order-insensitive hash of the values."""

import datetime as dt
import hashlib
import math
import sys
import time

sys.path.insert(0, "/root/repo")

import duckdb

from boxoffice.oracle import ORACLE_SQL
from boxoffice.queries import REGISTRY
from boxoffice.session import get_session

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{round(v, 6):.6f}"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.strftime("%Y-%m-%d %H:%M:%S.%f")
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return norm(v.item())
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest()[:12], lines


def main():
    sf = sys.argv[1]
    names = sys.argv[2:] or [n for n in REGISTRY if n in ORACLE_SQL]
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    spark = get_session("local[8]", shuffle_partitions=8)
    bad = 0
    for n in names:
        t = time.time()
        try:
            df = REGISTRY[n](spark, sf)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
            ts = time.time() - t
            res = con.execute(ORACLE_SQL[n])
            ocols = [d[0] for d in res.description]
            orows = res.fetchall()
            hs, ls = digest(scols, srows)
            ho, lo = digest(ocols, orows)
            ok = (len(srows) == len(orows)) and sorted(scols) == sorted(ocols) and hs == ho
            print(f"{'PASS' if ok else 'FAIL'} {n:26s} spark={len(srows):7d} oracle={len(orows):7d} {ts:6.2f}s",
                  flush=True)
            if not ok:
                bad += 1
                if sorted(scols) != sorted(ocols):
                    print("   cols spark:", sorted(scols), "\n   cols oracle:", sorted(ocols))
                else:
                    only_s = sorted(set(ls) - set(lo))[:3]
                    only_o = sorted(set(lo) - set(ls))[:3]
                    print("   cols:", sorted(scols))
                    print("   spark-only:", only_s)
                    print("   oracle-only:", only_o)
        except Exception as e:
            bad += 1
            print(f"ERROR {n}: {type(e).__name__}: {str(e)[:600]}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()
