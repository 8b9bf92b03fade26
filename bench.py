"""Benchmark: every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Derived tables (staging, feeds, warehouse) are built once first and timed as
``setup``; then each query runs to completion (noop sink, all rows computed,
nothing collected) and is timed warm. Seconds go to stderr as they come; prints one JSON line."""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from boxoffice.plans import staging as stg  # noqa: E402
from boxoffice.plans import warehouse as wh  # noqa: E402
from boxoffice.queries import REGISTRY  # noqa: E402
from boxoffice.session import get_session  # noqa: E402
from boxoffice.workspace import Workspace  # noqa: E402


def run(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or list(REGISTRY)
    spark = get_session(f"local[{cpus}]", shuffle_partitions=cpus)
    ws = Workspace(spark, sf_dir)
    t0 = time.time()
    stg.sales_source(ws)
    for e in stg.ENTITIES:
        stg.staged(ws, e)
        stg.snapshot(ws, e)
    stg.csv_feed(ws), stg.xml_feed(ws), stg.weblog_path(ws)
    stg.staged_csv(ws), stg.staged_xml(ws), stg.csv_errors(ws)
    wh.fact_table(ws)
    for m in ("customers", "company", "products", "order_request"):
        wh.mart(ws, m)
    setup = time.time() - t0
    print(f"setup {setup:.1f}", file=sys.stderr, flush=True)
    times = {}
    for n in names:
        t = time.time()
        run(REGISTRY[n](spark, sf_dir))
        times[n] = round(time.time() - t, 3)
        print(f"{n} {times[n]}", file=sys.stderr, flush=True)
    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec",
                      "queries": times, "setup_sec": round(setup, 3), "sf": sf,
                      "spark": spark.version, "cpus": cpus,
                      "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions"))}))


if __name__ == "__main__":
    main()
