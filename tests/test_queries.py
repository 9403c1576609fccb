"""Every registered query against its DuckDB oracle, and plan-shape checks."""
import datetime
import decimal
import math

import duckdb
import pytest

from tessera.plans.oracle import SQL
from tessera.plans.queries import QUERIES
from tessera.sources.tables import TABLES

from conftest import SF001, SF01

# Fits need more rows than the smallest tables hold.
LARGER = {"gbt_predictions", "mlp_predictions", "prediction_grid", "sql_stage_predictions", "next_day_predictions",
          "feature_ablation", "gbt_early_stop"}


def _norm(v):
    if isinstance(v, (float, decimal.Decimal)):
        f = float(v)
        return "nan" if math.isnan(f) else repr(f)
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _key(r):
    return tuple((x is None, str(x)) for x in r)


def _duck(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


@pytest.fixture(scope="module")
def duck():
    return {SF001: _duck(SF001), SF01: _duck(SF01)}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    folder = SF01 if name in LARGER else SF001
    df = QUERIES[name](spark, folder)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=_key)
    cur = duck[folder].execute(SQL[name])
    dcols = [d[0] for d in cur.description]
    idx = sorted(range(len(dcols)), key=lambda i: dcols[i])
    exp = sorted((tuple(_norm(r[i]) for i in idx) for r in cur.fetchall()), key=_key)
    assert cols == sorted(dcols)
    assert got == exp


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_evaluation_in_batch_plans(spark):
    for name in ("wordcount_whitespace", "log_parse", "path_to_hour", "first_passage_mean",
                 "rgb_to_lab", "json_roundtrip", "hash_split", "upsert_latest"):
        p = _plan(QUERIES[name](spark, SF001))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_scans_are_pruned(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    p = _plan(QUERIES["mean_by_key"](spark, SF001))
    assert "ReadSchema: struct<event_type:string,value:double>" in p
    p = _plan(QUERIES["previous_day_features"](spark, SF001))
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in p



def test_registered_keys_cover_oracle(spark):
    assert set(SQL) == set(QUERIES)


def test_winners_and_ranges_hash_aggregate(spark):
    from tessera.operators import ranges, topgroup
    from tessera.sources import derived
    p = _plan(ranges.station_ranges(derived.observations(spark, SF001)))
    assert "SortAggregate" not in p and p.count("FileScan") == 1
    p = _plan(topgroup.group_maxima(derived.pagecounts(spark, SF001), "hour", "views"))
    assert "SortAggregate" not in p


def test_sorted_results(spark):
    for name, key in (("relative_score_join", lambda r: (-r.relative_score, r.event_id)),
                      ("relative_score_broadcast", lambda r: (-r.relative_score, r.event_id)),
                      ("range_leader_sql", lambda r: (r.date, r.station)),
                      ("top_pages_text", lambda r: (r.hour, r.title)),
                      ("spend_by_flags", lambda r: (r.segment_outside, r.inside))):
        got = QUERIES[name](spark, SF001).collect()
        assert got and got == sorted(got, key=key), name


def test_registered_views_answer_sql(spark):
    from tessera.plans.sql_reports import flags_view
    from tessera.sources.tables import load, register_views
    register_views(spark, SF001, ["nation", "customer"])
    n = spark.sql("SELECT count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey").first().n
    assert n == load(spark, SF001, "customer").count()
    name = flags_view(spark, spark.table("customer"), spark.table("nation"), 2)
    assert spark.sql(f"SELECT * FROM {name}").count() == n
