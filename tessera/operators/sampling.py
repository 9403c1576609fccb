"""Monte Carlo first-passage count (estimate of e) and seeded hash splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.random import TWO_52, draw52, hash_bucket
from .partitioning import spread

# 32 draws: the chance that 32 uniforms sum below 1 is 1/32! (about 4e-36),
# so no sample at any realistic scale runs out; one that did fails the job
# instead of leaving the mean.
MAX_DRAWS = 32


def draws_to_pass_one(id_col: str, seed=42, max_draws: int = MAX_DRAWS) -> F.Column:
    """Number of uniform draws until their sum reaches 1, per row.

    ``aggregate`` over ``sequence(1, max_draws)`` with a short-circuiting
    ``if``: once the running sum passes 2**52 later md5 draws are not
    computed, so a row costs e (about 2.7) hashes on average.  Sums are
    52-bit integers, hence exact.
    """
    idc = F.col(id_col)
    init = F.struct(F.lit(0).cast("bigint").alias("s"), F.lit(0).alias("n"))

    def step(acc, k):
        return F.when(acc["s"] >= F.lit(TWO_52), acc).otherwise(
            F.struct((acc["s"] + draw52(seed, idc, k)).alias("s"), (acc["n"] + 1).alias("n")))

    return F.aggregate(F.sequence(F.lit(1), F.lit(max_draws)), init, step,
                       lambda acc: F.when(acc["s"] >= F.lit(TWO_52), acc["n"]).otherwise(
                           F.raise_error(F.lit(f"no passage within {max_draws} draws")).cast("int")))


def first_passage_mean(df: DataFrame, id_col: str, seed=42,
                       min_partitions: int | None = None) -> DataFrame:
    """One row (samples, mean_draws): every input row is one sample.

    Partial sums per task, one final merge: no row leaves its task.
    """
    if min_partitions:
        df = spread(df.select(id_col), min_partitions)
    n = draws_to_pass_one(id_col, seed)
    d = df.select(n.alias("_n"))
    return d.agg(F.count("_n").alias("samples"),
                 (F.sum("_n").cast("double") / F.count("_n")).alias("mean_draws"))


def first_passage_by_partition(df: DataFrame, id_col: str, seed=42) -> DataFrame:
    """(partition, samples, draws) per input partition, as the original's
    per-slice counts; the partition count is the caller's ``repartition``."""
    n = draws_to_pass_one(id_col, seed)
    return (df.select(F.spark_partition_id().alias("partition"), n.alias("_n"))
              .groupBy("partition").agg(F.count("_n").alias("samples"),
                                        F.sum("_n").alias("draws")))


def hash_split(df: DataFrame, id_col: str, seed=40, train_percent: int = 75,
               out: str = "split") -> DataFrame:
    """Deterministic train/validation label: md5 bucket < ``train_percent``."""
    b = hash_bucket(seed, F.col(id_col), 100)
    return df.withColumn(out, F.when(b < train_percent, "train").otherwise("validation"))
