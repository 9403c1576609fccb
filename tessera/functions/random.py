"""Seeded, partition-independent pseudo-random draws from md5.

A draw is the first 52 bits (13 hex digits) of ``md5('<seed>:<id>:<k>')``
as an integer; divided by 2**52 it is uniform on [0, 1).  The value depends
only on (seed, id, k), never on partitioning, task retries or executor
loss, so reruns reproduce every draw.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_52 = 1 << 52


def draw52(seed, id_col: Column, k: Column) -> Column:
    key = F.concat_ws(":", F.lit(str(seed)), id_col.cast("string"), k.cast("string"))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("bigint")


def uniform(seed, id_col: Column, k) -> Column:
    k = k if isinstance(k, Column) else F.lit(k)
    return draw52(seed, id_col, k) / F.lit(float(TWO_52))


def hash_bucket(seed, id_col: Column, buckets: int = 100) -> Column:
    """Bucket in [0, buckets) from the first 32 bits of ``md5('<seed>:<id>')``."""
    key = F.concat_ws(":", F.lit(str(seed)), id_col.cast("string"))
    return (F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint") % buckets).cast("int")
