"""Write the final (post-AQE) physical plans of key queries to docs/PLANS.md."""
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from tessera.plans.queries import QUERIES  # noqa: E402
from tessera.session import build_session  # noqa: E402

SF = os.environ.get("SF_DIR", "/root/testdata/sf0.1")
KEYS = ["wordcount_delimited", "max_by_group_ties", "relative_score_broadcast", "range_leader_df",
        "log_host_totals", "upsert_latest", "spend_by_flags", "semi_join_like", "etl_pushdown",
        "first_passage_mean", "previous_day_features", "top_k_rows"]

spark = build_session("local[8]", shuffle_partitions=16)
spark.conf.set("spark.sql.maxMetadataStringLength", "400")
out = ["# Final physical plans (sf0.1, local[8], AQE on)", "",
       "Generated by `tools/explain_plans.py`; each plan is the adaptive plan after the",
       "query ran (`isFinalPlan=true`), so runtime broadcast/coalesce decisions show.", ""]
for k in KEYS:
    df = QUERIES[k](spark, SF)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    out += [f"## {k}", "", "```", plan.rstrip(), "```", ""]
    print(k, flush=True)
open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "PLANS.md"),
     "w").write("\n".join(out))
