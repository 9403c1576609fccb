"""Readers and writers: JSON schema (X3), CSV sinks, split outputs, path sink."""
import json
import os

from pyspark.sql import functions as F

from tessera.sinks import write_csv, write_json, write_path, write_split, write_tab_separated
from tessera.sources.readers import read_json, read_text, with_source_file
from tessera.sources.schemas import COMMENT_FULL_SCHEMA

from conftest import rows


def test_full_comment_schema_with_null_and_extra_fields(spark, tmp_path):
    p = tmp_path / "c.json"
    p.write_text(json.dumps({"subreddit": "a", "score": None, "extra": 1, "author": "x"}) + "\n"
                 + json.dumps({"subreddit": "a", "score": 4}) + "\n")
    df = read_json(spark, str(p), COMMENT_FULL_SCHEMA)
    assert len(df.columns) == 21
    assert rows(df.groupBy("subreddit").agg(F.avg("score"))) == [("a", 4.0)]
    plan = df.select("subreddit", "score")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<score:bigint,subreddit:string>" in plan


def test_text_source_file_and_spread(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "a.txt").write_text("x\ny\n")
    df = with_source_file(read_text(spark, str(tmp_path / "t"), min_partitions=3))
    assert df.rdd.getNumPartitions() == 3
    assert all(r.source_file.endswith("a.txt") for r in df.collect())


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", -2)], "k string, v int")
    write_json(df, str(tmp_path / "j"), gzip=True)
    assert any(f.endswith(".json.gz") for f in os.listdir(tmp_path / "j"))
    assert rows(spark.read.json(str(tmp_path / "j")), "k", "v") == [("a", 1), ("b", -2)]
    write_csv(df, str(tmp_path / "c"))
    assert rows(spark.read.csv(str(tmp_path / "c"), schema="k string, v int")) == [("a", 1), ("b", -2)]
    write_tab_separated(df, str(tmp_path / "t"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "t")).collect()) == ["a\t1", "b\t-2"]
    write_split(df.where("v > 0"), df.where("v <= 0"), str(tmp_path / "s"))
    assert rows(spark.read.json(str(tmp_path / "s" / "negative")), "k") == [("b",)]
    path = spark.createDataFrame([(2, 7), (0, 9), (1, 3)], "step int, node long")
    write_path(path, str(tmp_path / "p"))
    assert [r.value for r in spark.read.text(str(tmp_path / "p")).collect()] == ["9", "3", "7"]


def test_gzip_text_and_generic_table_io(spark, tmp_path):
    import gzip
    d = tmp_path / "gz"
    d.mkdir()
    with gzip.open(d / "part-0.gz", "wt") as f:
        f.write("a b\nc\n")
    df = read_text(spark, str(d), min_partitions=2)
    assert sorted(r.value for r in df.collect()) == ["a b", "c"]
    from tessera.sinks import write_table
    from tessera.sources.readers import read_table
    write_table(df, "parquet", str(tmp_path / "t"))
    write_table(df, "parquet", str(tmp_path / "t"))          # overwrite, not append
    assert read_table(spark, "parquet", str(tmp_path / "t")).count() == 2


def test_random_ids_are_unique(spark):
    from tessera.operators.logs import parse_log_lines
    line = 'h - - [01/Aug/1995:00:00:01 -0400] "GET / HTTP/1.0" 200 5'
    df = spark.createDataFrame([(line,), (line,)], "value string")
    ids = [r.id for r in parse_log_lines(df, id_mode="random").collect()]
    assert len(set(ids)) == 2


def test_split_in_one_pass(spark, tmp_path):
    from pyspark.sql import functions as F
    from tessera.sinks import write_split_once
    df = spark.createDataFrame([(1, 5), (2, 0), (3, None), (4, -2)], "id int, v int")
    write_split_once(df, F.col("v") > 0, str(tmp_path / "one"))
    ids = {s: {r.id for r in spark.read.json(str(tmp_path / "one" / f"side={s}")).collect()}
           for s in ("positive", "negative")}
    assert ids == {"positive": {1}, "negative": {2, 4}}
