"""Run every registered query once and print row counts and timings."""
import os, sys, time
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from tessera.session import build_session
from tessera.plans.queries import QUERIES

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
only = sys.argv[2].split(",") if len(sys.argv) > 2 else None
spark = build_session("local[8]", shuffle_partitions=8)
for name, fn in QUERIES.items():
    if only and name not in only:
        continue
    t = time.time()
    try:
        df = fn(spark, sf)
        n = df.count()
        print(f"{name:28s} rows={n:8d} {time.time()-t:6.2f}s {df.columns}", flush=True)
    except Exception as e:
        print(f"{name:28s} ERROR {type(e).__name__}: {str(e)[:400]}", flush=True)
