"""Exact median per group without gathering any group in one task.

Spark's ``median``/``percentile`` keeps a value->count map per group and
merges each group's map in a single task, so one group holding a third of
a huge table means one task holding all of its distinct values.  Here:

1. count rows per (group, value)            -- partial aggregation; a hot
                                               group spreads over values
2. range-partition those distinct pairs by (group, value) and stamp each
   with its partition id; written once to the checkpoint folder
3. per (partition, group): row totals       -- tiny (partitions x groups)
   prefix sums over partitions per group give the global rank range each
   partition covers, and which partition holds ranks floor((n-1)/2) and
   ceil((n-1)/2)
4. only inside those (partition, group) slices, a running count over the
   sorted distinct values finds the two middle values; a slice is bounded
   by one range partition, never by a group.

The median is the mean of the two middle values (the usual interpolation
at 0.5), as a double.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .joins import broadcast_if_small, materialize


def value_counts(df: DataFrame, group_cols: list[str], value: str) -> DataFrame:
    """(group cols..., value, _c): rows per distinct value of each group
    (partial aggregation; null values kept as their own row)."""
    return df.groupBy(*group_cols, value).agg(F.count(F.lit(1)).alias("_c"))


def exact_median(df: DataFrame, group_cols: list[str], value: str, out: str = "median",
                 partitions: int | None = None, counted: bool = False) -> DataFrame:
    """(group cols..., out) with the exact median of ``value`` per group (nulls ignored).

    With ``counted=True`` ``df`` is already ``value_counts`` output, so a
    caller that also needs counts or sums reads the data only once.
    """
    spark = df.sparkSession
    g = list(group_cols)
    p = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = df if counted else value_counts(df, g, value)
    counts = counts.where(F.col(value).isNotNull())
    ranged = materialize(counts.repartitionByRange(p, *g, value)
                               .withColumn("_pid", F.spark_partition_id()))

    per_part = ranged.groupBy("_pid", *g).agg(F.sum("_c").alias("_pc"))
    by_group = Window.partitionBy(*g)
    slices = (per_part
              .withColumn("_before", F.sum("_pc").over(by_group.orderBy("_pid")) - F.col("_pc"))
              .withColumn("_n", F.sum("_pc").over(by_group))
              .withColumn("_lo", F.floor((F.col("_n") - 1) / 2))
              .withColumn("_hi", F.ceil((F.col("_n") - 1) / 2)))
    end = F.col("_before") + F.col("_pc")
    holds = lambda r: (F.col(r) >= F.col("_before")) & (F.col(r) < end)
    need = slices.where(holds("_lo") | holds("_hi")).select(
        *[F.col(c).alias(f"_k_{c}") for c in ["_pid", *g]], "_before", "_lo", "_hi")
    n, _ = broadcast_if_small(need)   # at most two rows per group
    on = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in ["_pid", *g]]
    cand = ranged.join(n, on)
    run = F.sum("_c").over(Window.partitionBy("_pid", *g).orderBy(value))
    cand = cand.withColumn("_end", F.col("_before") + run)
    start = F.col("_end") - F.col("_c")
    at = lambda r: (F.col(r) >= start) & (F.col(r) < F.col("_end"))
    mid = cand.groupBy(*g).agg(F.max(F.when(at("_lo"), F.col(value))).alias("_vlo"),
                               F.max(F.when(at("_hi"), F.col(value))).alias("_vhi"))
    return mid.select(*g, ((F.col("_vlo").cast("double") + F.col("_vhi").cast("double")) / 2.0)
                      .alias(out))
