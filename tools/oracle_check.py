"""Compare every registered query with its DuckDB oracle (rows, columns, values)."""
import datetime, decimal, math, os, sys, time
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import duckdb
from tessera.session import build_session
from tessera.plans.queries import QUERIES
from tessera.plans.oracle import SQL
from tessera.sources.tables import TABLES

sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
only = sys.argv[1].split(",") if len(sys.argv) > 1 else None


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (float, decimal.Decimal)):
        f = float(v)
        return "nan" if math.isnan(f) else repr(f)
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


con = duckdb.connect()
for t in TABLES:
    con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
if os.environ.get("PLAIN"):   # the driver's kind of session: defaults only
    from pyspark.sql import SparkSession
    b = SparkSession.builder.master("local[8]")
    if os.environ.get("TZ_OVERRIDE"):
        b = b.config("spark.sql.session.timeZone", os.environ["TZ_OVERRIDE"])
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
else:
    spark = build_session("local[8]", shuffle_partitions=8)
ok = bad = 0
for name, fn in QUERIES.items():
    if only and name not in only:
        continue
    if name not in SQL:
        print(f"{name:28s} (no oracle)")
        continue
    t = time.time()
    try:
        sdf = fn(spark, sf)
        scols = sdf.columns
        srows = [tuple(norm(r[c]) for c in sorted(scols)) for r in sdf.collect()]
        cur = con.execute(SQL[name])
        dcols = [d[0] for d in cur.description]
        drows_raw = cur.fetchall()
        idx = sorted(range(len(dcols)), key=lambda i: dcols[i])
        drows = [tuple(norm(r[i]) for i in idx) for r in drows_raw]
    except Exception as e:
        bad += 1
        print(f"{name:28s} ERROR {type(e).__name__}: {str(e)[:600]}")
        continue
    same_cols = sorted(scols) == sorted(dcols)
    key = lambda r: tuple((x is None, str(x)) for x in r)
    ss, dd = sorted(srows, key=key), sorted(drows, key=key)
    if same_cols and ss == dd:
        ok += 1
        print(f"{name:28s} OK rows={len(ss)} {time.time()-t:.1f}s")
    else:
        bad += 1
        print(f"{name:28s} MISMATCH cols_equal={same_cols} spark={sorted(scols)} duck={sorted(dcols)} rows {len(ss)} vs {len(dd)}")
        sset, dset = set(ss), set(dd)
        print("   spark-only:", list(sset - dset)[:3])
        print("   duck-only: ", list(dset - sset)[:3])
print(f"ok={ok} bad={bad}")
