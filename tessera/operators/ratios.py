"""Group means and each row's value relative to its group mean."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import broadcast_if_small, materialize


def exact_mean(c) -> F.Column:
    """Mean as one double division of an exact (integer) sum by the count.

    For integer inputs the sum is exact in any order, so the result is
    bit-identical across partitionings and engines.
    """
    c = F.col(c) if isinstance(c, str) else c
    return F.sum(c).cast("double") / F.count(c)


def mean_by_key(df: DataFrame, key: str, value: str, out: str | None = None,
                scale: float | None = None) -> DataFrame:
    """Mean of ``value`` per ``key`` (partial then final aggregate).

    ``scale`` divides the mean (used with integer cents: ``scale=100``).
    Null values are ignored, as ``avg`` does; a key with only nulls gets null.
    """
    m = exact_mean(value)
    if scale:
        m = m / F.lit(float(scale))
    return df.groupBy(key).agg(m.alias(out or f"avg_{value}"))


def relative_score(df: DataFrame, key: str, value: str, keep: list[str],
                   strategy: str = "join", out: str = "relative_score",
                   descending: bool = False) -> DataFrame:
    """``value / mean(value of its key)`` for every row.

    strategy:
      * ``join``      shuffle join with the stored per-key means (AQE may
                      demote it to a broadcast at runtime, or split a hot
                      key's partition);
      * ``broadcast`` means broadcast after a row-count check (falls back to
                      the shuffle join when there are too many keys);
      * ``window``    ``avg() over (partition by key)``: one scan, but one
                      task per key, so only for keys known to be balanced.
    A zero mean gives null (``try_divide``); negative means are kept.
    ``descending`` sorts by the score, best first (a range-partitioned sort).
    """
    v = F.col(value)
    if strategy == "window":
        from pyspark.sql import Window
        w = Window.partitionBy(key)
        mean = F.sum(v).over(w).cast("double") / F.count(v).over(w)
        scored = df.select(*keep, key, F.try_divide(v, mean).alias(out))
        return scored.orderBy(F.col(out).desc_nulls_last(), *keep) if descending else scored
    means = df.groupBy(key).agg(exact_mean(value).alias("_mean")).withColumnRenamed(key, "_k")
    if strategy == "broadcast":
        means, _ = broadcast_if_small(means)
    elif strategy == "join":
        # Joined straight onto its own aggregate, the means side would sit
        # under the join as HashAggregate(shuffle), a shape AQE's skew-join
        # split cannot handle.  Stored once, it is a plain shuffle stage,
        # so a key holding a third of the rows is split across tasks (or
        # the side is broadcast at runtime when AQE sees it is small).
        means = materialize(means)
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    j = df.join(means, F.col(key) == F.col("_k"))
    scored = j.select(*keep, key, F.try_divide(v, F.col("_mean")).alias(out))
    return scored.orderBy(F.col(out).desc_nulls_last(), *keep) if descending else scored
