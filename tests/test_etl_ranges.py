"""Comment/weather ETL and the daily range leader (against brute-force pairs)."""
import itertools
from collections import defaultdict

from pyspark.sql import functions as F

from tessera.operators.etl import comment_split, weather_etl
from tessera.operators.ranges import range_leader, range_leader_sql
from tessera.sources.readers import read_csv
from tessera.sources.schemas import WEATHER_SCHEMA

from conftest import rows

WEATHER = [
    "CA001,20160101,TMAX,105,,,,0700",
    "CA001,20160101,TMIN,-20,,,,0700",
    "CA001,20160101,TMAX,105,,,,0800",     # duplicate (station, date, observation)
    "CA002,20160101,TMAX,200,,X,,0700",    # flagged
    "CA002,20160101,TMIN,70,,,,0700",
    "US003,20160101,TMAX,150,,,,0700",     # other country
    "US003,20160101,TMIN,25,,,,0700",      # ties CA001's range 12.5
    "CA004,20160102,TMAX,90,,,,0700",      # TMAX without TMIN
    "CA005,20160102,TMAX,,,,,0700",        # null value
    "CA005,20160102,TMIN,10,,,,0700",
    "CA006,20160102,TMAX,50,,,,0700",
    "CA006,20160102,TMIN,10,,,,0700",
]


def _weather(spark, tmp_path):
    p = tmp_path / "w.csv"
    p.write_text("\n".join(WEATHER) + "\n")
    return read_csv(spark, str(p), WEATHER_SCHEMA)


def test_weather_etl(spark, tmp_path):
    got = rows(weather_etl(_weather(spark, tmp_path), "CA", "TMAX"))
    assert got == [("CA001", "20160101", 10.5), ("CA001", "20160101", 10.5),
                   ("CA004", "20160102", 9.0), ("CA005", "20160102", None),  # null kept, as before
                   ("CA006", "20160102", 5.0)]


def test_weather_etl_filters_reach_the_parquet_scan(spark, tmp_path):
    path = str(tmp_path / "w.parquet")
    _weather(spark, tmp_path).write.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = weather_etl(spark.read.parquet(path), "CA", "TMAX")._jdf.queryExecution() \
        .executedPlan().toString()
    pushed = plan[plan.index("PushedFilters: ["):]
    pushed = pushed[:pushed.index("]")]
    for f in ("IsNull(qflag)", "StringStartsWith(station,CA)", "EqualTo(observation,TMAX)"):
        assert f in pushed
    assert "ReadSchema: struct<station:string,date:string,observation:string,value:int,qflag:string>" in plan


def brute_force_leaders(obs):
    """Every TMAX x TMIN pair of a (station, date); keep the date's largest range."""
    mx, mn = defaultdict(list), defaultdict(list)
    for st, d, o, v, q in obs:
        if q is None and v is not None and o == "TMAX":
            mx[(st, d)].append(v)
        elif q is None and v is not None and o == "TMIN":
            mn[(st, d)].append(v)
    pairs = [(d, st, (a - b) / 10.0) for (st, d), highs in mx.items()
             for a, b in itertools.product(highs, mn.get((st, d), []))]
    best = defaultdict(lambda: float("-inf"))
    for d, st, r in pairs:
        best[d] = max(best[d], r)
    return sorted(p for p in pairs if p[2] == best[p[0]])


def _per_pair(leaders):
    return sorted(((r.date, r.station, r.range) for r in leaders.collect() for _ in range(r.pairs)),
                  key=lambda t: tuple((x is None, str(x)) for x in t))


def test_range_leader_matches_pair_join(spark, tmp_path):
    df = _weather(spark, tmp_path).select("station", "date", "observation", "value", "qflag")
    exp = brute_force_leaders([tuple(r) for r in df.collect()])
    assert rows(range_leader(df, repeat=True), "date", "station", "range") == exp
    assert _per_pair(range_leader_sql(spark, df)) == exp
    # the duplicate TMAX row doubles CA001's leading pair; US003 ties it
    assert exp.count(("20160101", "CA001", 12.5)) == 2 and ("20160101", "US003", 12.5) in exp


def test_comment_split(spark):
    df = spark.createDataFrame(
        [("hello", 3, "a"), ("hello", 0, "b"), ("hello", -1, "c"), ("xyz", 5, "d"), ("hello", None, "e")],
        "subreddit string, score long, author string")
    pos, neg = comment_split(df)
    assert rows(pos) == [("hello", 3, "a")]
    assert rows(neg) == [("hello", -1, "c"), ("hello", 0, "b")]


def test_repeat_rows_blocks(spark):
    from tessera.operators.ranges import repeat_rows
    df = spark.createDataFrame([("a", 0), ("b", 1), ("c", 4096), ("d", 10000)], "k string, n long")
    got = dict(rows(repeat_rows(df, "n").groupBy("k").count()))
    assert got == {"b": 1, "c": 4096, "d": 10000}


from hypothesis import HealthCheck, given, settings, strategies as st  # noqa: E402


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["S1", "S2", "S3"]), st.sampled_from(["d1", "d2"]),
                          st.sampled_from(["TMAX", "TMIN", "PRCP"]),
                          st.one_of(st.none(), st.integers(-30, 30)),
                          st.sampled_from([None, None, "X"])),
                min_size=1, max_size=60))
def test_range_leader_matches_pair_join_on_random_obs(spark, obs):
    df = spark.createDataFrame(obs, "station string, date string, observation string, value int, qflag string")
    exp = brute_force_leaders(obs)
    assert rows(range_leader(df, repeat=True), "date", "station", "range") == exp
    assert _per_pair(range_leader_sql(spark, df)) == exp
