"""Clustered copies, quarantined lines, compressed folders, cached frames, nested columns."""
import gzip
import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark import StorageLevel
from pyspark.sql import functions as F

from tessera import sinks
from tessera.operators import etl, reports
from tessera.operators.caching import held, held_bytes
from tessera.plans.queries import PART_PATTERN
from tessera.sources import derived
from tessera.sources.clustered import rows_scanned, write_clustered
from tessera.sources.quarantine import split_lines
from tessera.sources.readers import read_compressed_lines
from tessera.sources.schemas import COMMENT_SCHEMA, PAGECOUNT_FILE_SCHEMA, WEATHER_SCHEMA
from tessera.sources.tables import load

from conftest import SF001, SF01, rows


# --- clustered copies --------------------------------------------------------

def test_clustered_copy_skips_rows(spark, tmp_path):
    obs = derived.observations(spark, SF01)
    plain, sorted_ = str(tmp_path / "plain"), str(tmp_path / "sorted")
    obs.write.parquet(plain)
    write_clustered(obs, sorted_, ["observation", "station", "date"], bloom=("station",), partitions=8, row_group_bytes=4096)
    pick = lambda p: etl.weather_etl(spark.read.parquet(p), "U1", "TMAX")
    assert rows(pick(sorted_)) == rows(pick(plain)) and pick(plain).count() > 500
    assert rows_scanned(pick(plain)) == obs.count()
    assert rows_scanned(pick(sorted_)) < 0.35 * obs.count()


def test_bloom_filter_rules_out_row_groups(spark, tmp_path):
    """Values that the sort does not separate: min and max span nearly all."""
    df = spark.range(0, 40000, 1, 4).select("id", F.md5(F.col("id").cast("string")).alias("key"))
    for name, bloom in (("with", ("key",)), ("without", ())):
        write_clustered(df, str(tmp_path / name), ["id"], bloom, partitions=4, row_group_bytes=65536)
    wanted = df.where("id = 12345").first().key
    pick = lambda n: spark.read.parquet(str(tmp_path / n)).where(F.col("key") == wanted)
    assert rows(pick("with")) == rows(pick("without")) == [(12345, wanted)]
    assert rows_scanned(pick("with")) < 0.5 * rows_scanned(pick("without"))


def test_hot_key_is_cut_by_the_next_column(spark, tmp_path):
    df = spark.range(0, 30000, 1, 3).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    write_clustered(df, str(tmp_path / "t"), ["k", "id"], partitions=8)
    sizes = [r["count"] for r in spark.read.parquet(str(tmp_path / "t")).groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 30000 and max(sizes) < 2 * 30000 / 8


# --- quarantine ---------------------------------------------------------------

def _write(path, lines):
    path.mkdir()
    (path / "a.txt").write_text("\n".join(lines) + "\n")


JSON_LINES = [
    ('{"subreddit": "a", "score": 1, "author": "x"}', None),
    ('{"author": "x", "score": -2, "subreddit": "a", "more": {"k": [1]}}', None),
    ('{"subreddit": "a", "score": null}', "missing: score"),
    ('{"subreddit": "a"}', "missing: score"),
    ('{"score": 3}', "missing: subreddit"),
    ('{"subreddit": "a", "score": "3x"}', "wrong type: score"),
    ('{"subreddit": "a", "score": 1.5}', "wrong type: score"),
    ('{"subreddit": "a", "score": 1', "malformed"),
    ("not json", "malformed"), ("[1, 2]", "malformed"), ("null", "malformed"), ('"text"', "malformed"),
    ("   ", "blank"), ("{}", "missing: subreddit"),
    ('  {"subreddit": "é", "score": 7, "author": null}', None),
]


def test_json_lines(spark, tmp_path):
    _write(tmp_path / "in", [x for x, _ in JSON_LINES])
    good, bad = split_lines(spark, str(tmp_path / "in"), "json", COMMENT_SCHEMA, ("subreddit", "score"))
    assert good.schema == COMMENT_SCHEMA
    assert rows(good) == sorted([("a", 1, "x"), ("a", -2, "x"), ("é", 7, None)])
    want = sorted((x, why) for x, why in JSON_LINES if why not in (None, "blank"))
    assert rows(bad, "line", "reason") == want
    assert {r.file.rsplit("/", 1)[1] for r in bad.collect()} == {"a.txt"}


CSV_LINES = [
    ("S1,20240101,TMAX,12,,,E,0700", None),
    ("S1,20240101,TMAX,,,X,E,", None),
    (',20240101,TMAX,12,,,E,0700', "missing: station"),
    ("S1,20240101,TMAX,warm,,,E,0700", "wrong type: value"),
    ("S1,20240101,TMAX,12", "malformed"),
    ("S1,20240101,TMAX,12,,,E,0700,more", "malformed"),
    ("nothing", "malformed"), ("", "blank"),
    ('"S,1",20240101,"a ""b""",-3,,,E,0700', None),
]


def test_csv_lines(spark, tmp_path):
    _write(tmp_path / "in", [x for x, _ in CSV_LINES])
    good, bad = split_lines(spark, str(tmp_path / "in"), "csv", WEATHER_SCHEMA, ("station", "date"), {"escape": '"'})
    assert rows(good, "station", "observation", "value") == sorted(
        [("S1", "TMAX", 12), ("S1", "TMAX", None), ("S,1", 'a "b"', -3)], key=lambda r: tuple((x is None, str(x)) for x in r))
    assert rows(bad, "line", "reason") == sorted((x, why) for x, why in CSV_LINES if why not in (None, "blank"))


def test_space_delimited_lines(spark, tmp_path):
    _write(tmp_path / "in", ['en "Quoted 5 0', "en Page x 0", "en Page 7"])
    good, bad = split_lines(spark, str(tmp_path / "in"), "csv", PAGECOUNT_FILE_SCHEMA, (), {"sep": " ", "quote": ""})
    assert rows(good) == [("en", '"Quoted', 5, 0)]
    assert rows(bad, "reason") == [("malformed",), ("wrong type: views",)]


def test_one_scan_and_empty_input(spark, tmp_path):
    _write(tmp_path / "in", [""])
    good, bad = split_lines(spark, str(tmp_path / "in"), "json", COMMENT_SCHEMA, ("score",))
    assert good.count() == 0 == bad.count() and bad.columns == ["file", "line", "reason"]
    with pytest.raises(ValueError):
        split_lines(spark, str(tmp_path / "in"), "xml", COMMENT_SCHEMA)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.text(alphabet='{}":, ascore1.5null[]x', max_size=20),
                          st.fixed_dictionaries({"subreddit": st.sampled_from(["a", None]), "score": st.sampled_from(
                              [1, "x", None, 2.5, [1], True])}).map(json.dumps)), max_size=25))
def test_every_line_is_in_one_part(spark, tmp_path_factory, lines):
    path = tmp_path_factory.mktemp("q") / "in"
    _write(path, lines)
    good, bad = split_lines(spark, str(path), "json", COMMENT_SCHEMA, ("subreddit", "score"))
    full = [x for x in lines if x.strip(" ")]
    assert good.count() + bad.count() == len(full)
    assert good.where("subreddit IS NULL OR score IS NULL").count() == 0
    assert {x for x in full if not x.strip(" ").startswith("{")} <= {r.line for r in bad.where("reason = 'malformed'").collect()}


# --- compressed folders, cached frames ------------------------------------------

def test_one_large_gzip_file_is_dealt_out(spark, tmp_path):
    (tmp_path / "logs").mkdir()
    for name, n in (("a.gz", 5000), ("b.gz", 10), ("c.gz", 10)):
        with gzip.open(tmp_path / "logs" / name, "wt") as f:
            f.writelines(f"{name} line {i} {i * 7919 % 1000003}\n" for i in range(n))
    lines = read_compressed_lines(spark, str(tmp_path / "logs"), partitions=3)
    assert lines.count() == 5020 and lines.distinct().count() == 5020
    sizes = [r["count"] for r in lines.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 3 and max(sizes) < 1.2 * 5020 / 3


def test_even_gzip_files_are_not_shuffled(spark, tmp_path):
    spark.range(8000).select(F.sha2(F.col("id").cast("string"), 256).alias("value")).repartition(8) \
        .write.option("compression", "gzip").text(str(tmp_path / "logs"))
    lines = read_compressed_lines(spark, str(tmp_path / "logs"), partitions=4)
    assert lines.count() == 8000 and "Exchange" not in lines._jdf.queryExecution().executedPlan().toString()


def _scan_counts(df, acc):
    from pyspark.sql.types import StringType
    return df.withColumn("group", F.udf(lambda x: (acc.add(1), x)[1], StringType())("group"))


def test_cached_split_scans_once(spark, tmp_path):
    """Both outputs from one pass over the source; without the cache, two."""
    base = spark.range(100).select(F.lit("e").alias("group"), (F.col("id") - 50).alias("score"), F.lit("u").alias("author"))
    counts = []
    for cached in (True, False):
        acc = spark.sparkContext.accumulator(0)
        df = _scan_counts(base, acc)
        parts = lambda x: etl.comment_split(x, group="group")
        if cached:
            with held(df, StorageLevel.MEMORY_ONLY) as kept:
                sinks.write_split(*parts(kept), str(tmp_path / "out1"))
                assert held_bytes(kept)[0] > 0
        else:
            sinks.write_split(*parts(df), str(tmp_path / "out2"))
        counts.append(acc.value)
    assert counts[0] == 100 and counts[1] >= 200
    for side, n in (("positive", 49), ("negative", 51)):
        assert spark.read.json(str(tmp_path / "out1" / side)).count() == n == spark.read.json(str(tmp_path / "out2" / side)).count()


def test_cache_is_released_after_an_error(spark):
    df = spark.range(10)
    with pytest.raises(ZeroDivisionError):
        with held(df, StorageLevel.DISK_ONLY) as kept:
            kept.count()
            assert kept.is_cached and held_bytes(kept)[1] > 0
            1 / 0
    assert not df.is_cached and held_bytes(df) == (0, 0)


# --- nested columns ---------------------------------------------------------------

def test_nested_leaf_is_pruned_and_pushed(spark, tmp_path):
    path = str(tmp_path / "amenities")
    derived.amenities(spark, SF001).write.parquet(path)
    flags = load(spark, SF001, "customer").select("c_custkey", F.lit(1).alias("in_region"))
    got = reports.semi_join_nested(spark.read.parquet(path), load(spark, SF001, "lineitem"), load(spark, SF001, "orders"),
                                   flags, "restaurant", PART_PATTERN)
    plan = got._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.split("\n") if "amenid" in x and "ReadSchema" in x)
    assert "ReadSchema: struct<amenid:bigint,amenity:string,tags:struct<cuisine:string>>" in scan
    assert "EqualTo(amenity,restaurant)" in scan and "IsNotNull(tags.cuisine)" in scan.replace("`", "")
    assert got.count() == 1


def test_nested_nulls_case_and_repeats(spark):
    amenities = spark.createDataFrame(
        [(1, "restaurant", ("Hot SUSHI", "k")), (1, "restaurant", ("sushi", "k")), (2, "restaurant", None),
         (3, "restaurant", (None, "k")), (4, "cafe", ("sushi", "k")), (5, "restaurant", ("pizza", "k"))],
        "amenid long, amenity string, tags struct<cuisine:string,kind:string>")
    sales = spark.createDataFrame([(10, i, float(i)) for i in range(1, 6)], "l_orderkey long, l_partkey long, l_extendedprice double")
    orders = spark.createDataFrame([(10, 7)], "o_orderkey long, o_custkey long")
    flags = spark.createDataFrame([(7, 1)], "c_custkey long, in_region int")
    assert rows(reports.semi_join_nested(amenities, sales, orders, flags, "restaurant", "%sushi%")) == [(1, 1.0)]
