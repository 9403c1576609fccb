"""A key holding a third of all rows: AQE splits it and results stay exact."""
import pytest
from pyspark.sql import functions as F

from tessera.operators.ratios import relative_score
from tessera.operators.upsert import latest_per_key

from conftest import rows

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _skewed(spark):
    # key 0 holds a third of 30,000 rows; the rest spread over 2,000 keys
    return spark.range(30000).select(
        F.col("id").alias("event_id"), (F.col("id") % 97).alias("author"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 2000 + 1).alias("key"),
        (F.col("id") * 7 % 1000).alias("cents"))


def test_hot_key_join_is_split_and_exact(spark, skew_conf):
    df = _skewed(spark)
    joined = relative_score(df, "key", "cents", ["event_id", "author"], strategy="join")
    got = rows(joined, "event_id", "relative_score")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan                      # AQE split the hot key's partition
    exp = rows(relative_score(df, "key", "cents", ["event_id", "author"], strategy="window"),
               "event_id", "relative_score")
    assert got == exp and len(got) == 30000


def test_hot_key_upsert_is_exact(spark, skew_conf):
    df = _skewed(spark)
    got = rows(latest_per_key(df, ["key"], ["cents", "event_id"]), "key", "cents", "event_id")
    assert len(got) == 2001
    hot = [r for r in got if r[0] == 0][0]
    assert hot[1:] == (999, max(i for i in range(0, 30000, 3) if i * 7 % 1000 == 999))


def test_hot_date_range_leader_is_exact(spark, skew_conf):
    from tessera.operators import joins
    from tessera.operators.ranges import range_leader
    import tessera.operators.ranges as ranges_mod
    # one date holds a third of the station-days; force the shuffle path
    obs = spark.range(6000).select(
        F.concat(F.lit("S"), (F.col("id") % 3000).cast("string")).alias("station"),
        F.when(F.col("id") % 3 == 0, F.lit("2020-01-01"))
         .otherwise(F.date_format(F.date_add(F.lit("2020-01-02"), (F.col("id") % 50).cast("int")),
                                  "yyyy-MM-dd")).cast("date").alias("date"),
        F.when(F.col("id") % 2 == 0, "TMAX").otherwise("TMIN").alias("observation"),
        (F.col("id") * 37 % 400).cast("int").alias("value"),
        F.lit(None).cast("string").alias("qflag"))
    orig = ranges_mod.broadcast_if_small
    ranges_mod.broadcast_if_small = lambda df: joins.broadcast_if_small(df, max_rows=1)
    try:
        got = rows(range_leader(obs, repeat=True), "date", "station", "range")
    finally:
        ranges_mod.broadcast_if_small = orig
    # brute force: every TMAX x TMIN pair of a (station, date), keep the date's maximum
    data = [tuple(r) for r in obs.collect()]
    hi, lo = {}, {}
    for st, d, o, v, _ in data:
        (hi if o == "TMAX" else lo).setdefault((st, d), []).append(v)
    pairs = [(d, st, (a - b) / 10.0) for (st, d), hs in hi.items() for a in hs for b in lo.get((st, d), [])]
    best = {}
    for d, st, r in pairs:
        best[d] = max(best.get(d, r), r)
    exp = sorted((p for p in pairs if p[2] == best[p[0]]), key=lambda t: tuple((x is None, str(x)) for x in t))
    assert got == exp
