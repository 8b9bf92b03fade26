"""Run registered queries on one input directory and print rows, schema and time."""
import sys, time, traceback
sys.path.insert(0, "/root/repo")
from boxoffice.session import get_session
from boxoffice.queries import REGISTRY

sf = sys.argv[1]
names = sys.argv[2:] or list(REGISTRY)
spark = get_session("local[8]", shuffle_partitions=8)
for n in names:
    t = time.time()
    try:
        df = REGISTRY[n](spark, sf)
        rows = df.collect()
        print(f"OK {n:28s} rows={len(rows):7d} {time.time()-t:6.2f}s {df.schema.simpleString()[:200]}", flush=True)
    except Exception as e:
        print(f"FAIL {n}: {type(e).__name__}: {str(e)[:1500]}", flush=True)
