"""Seeded md5 draws, first-passage mean (estimate of e), hash split."""
import hashlib
import math

from pyspark.sql import functions as F

from tessera.functions.random import TWO_52, draw52
from tessera.operators.sampling import (draws_to_pass_one, first_passage_by_partition,
                                        first_passage_mean, hash_split)


def py_draws(seed, i):
    s, n, k = 0, 0, 0
    while s < TWO_52:
        k += 1
        s += int(hashlib.md5(f"{seed}:{i}:{k}".encode()).hexdigest()[:13], 16)
        n += 1
    return n


def test_draws_match_python_md5(spark):
    df = spark.range(200).select(F.col("id"), draws_to_pass_one("id", 42).alias("n"))
    for r in df.collect():
        assert r.n == py_draws(42, r.id)
    one = spark.range(3).select(draw52(7, F.col("id"), F.lit(1)).alias("d")).collect()
    assert [r.d for r in one] == [int(hashlib.md5(f"7:{i}:1".encode()).hexdigest()[:13], 16)
                                  for i in range(3)]


def test_mean_is_near_e_and_partition_independent(spark):
    df = spark.range(0, 40000, numPartitions=3)
    (samples, mean), = [tuple(r) for r in first_passage_mean(df, "id").collect()]
    assert samples == 40000 and abs(mean - math.e) < 0.03
    (s2, m2), = [tuple(r) for r in first_passage_mean(df.repartition(11), "id", min_partitions=5).collect()]
    assert (s2, m2) == (samples, mean)
    parts = first_passage_by_partition(df, "id").collect()
    assert sum(p.samples for p in parts) == 40000 and sum(p.draws for p in parts) == round(mean * 40000)


def test_hash_split_is_deterministic(spark):
    a = hash_split(spark.range(10000), "id", 40)
    b = hash_split(spark.range(0, 10000, numPartitions=7), "id", 40)
    ra = {r.id: r.split for r in a.collect()}
    assert ra == {r.id: r.split for r in b.collect()}
    share = sum(v == "train" for v in ra.values()) / len(ra)
    assert 0.73 < share < 0.77
