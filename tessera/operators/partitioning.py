"""Spreading CPU-heavy row work over enough tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame


def cores(df: DataFrame) -> int:
    return df.sparkSession.sparkContext.defaultParallelism


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin ``df`` over ``min_partitions`` tasks (default: the
    cluster's cores) only when its input splits are fewer than that.

    Large inputs arrive in many splits and pass through untouched (no extra
    shuffle); a small input held in one file/row group would otherwise run
    its per-row work (regex tokenising, parsing, hashing) in a single task.
    """
    n = min_partitions or cores(df)
    if df.rdd.getNumPartitions() < n:
        return df.repartition(n)
    return df


def spread_rows(df: DataFrame) -> DataFrame:
    """Round-robin ``df`` over at least the cluster's cores, whatever its input
    splits: of a file's splits only those that hold the middle of a row group
    read rows, so a few large groups feed a few tasks.  For narrow rows that
    are read many times."""
    return df.repartition(max(cores(df), df.rdd.getNumPartitions()))
