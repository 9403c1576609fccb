"""Exact money arithmetic helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents(c) -> Column:
    """Integer cents of a 2-decimal amount held as a double.

    Sums of cents are exact in any order, so means and medians computed
    from them do not depend on partitioning (or on the engine).
    """
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c * 100).cast("bigint")
