"""Keyed last-write-wins upsert over whole tables.

A key's surviving row is the one with the greatest ``order`` columns.  The
greatest first order column per key is a hash aggregate with map-side partial
maxima; joined back it leaves the few rows per key that reach it, and only
among those is the rest of the order resolved.  No group is gathered whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .joins import materialize


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in keys and c not in order]
    top = materialize(df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
                        .agg(F.max(order[0]).alias("_top")))
    same = F.col(order[0]).eqNullSafe(F.col("_top"))
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    best = F.max(F.struct(*[F.col(c) for c in order + rest])).alias("_w")
    return (df.join(top, same).groupBy(*keys).agg(best)
              .select(*keys, *[F.col(f"_w.{c}").alias(c) for c in order + rest])
              .select(*df.columns))


def merge(existing: DataFrame, updates: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Upsert ``updates`` into ``existing``: union then latest per key."""
    return latest_per_key(existing.unionByName(updates), keys, order)


def upsert_table(spark, path: str | None, updates: DataFrame, keys: list[str],
                 order: list[str], out_path: str | None = None) -> str:
    """Write ``merge(read(path), updates)`` to a NEW folder and return it.

    The folder being read is never overwritten; the caller switches its
    pointer to the returned path once the write has committed.
    """
    merged = (merge(spark.read.parquet(path), updates, keys, order) if path
              else latest_per_key(updates, keys, order))
    out_path = out_path or scratch_path(spark, "keyed")
    merged.write.mode("errorifexists").parquet(out_path)
    return out_path
