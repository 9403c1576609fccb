"""Set operations and distinct keys."""

from __future__ import annotations

from pyspark.sql import DataFrame


def except_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of ``a`` not in ``b``, without duplicates (SQL EXCEPT)."""
    return a.subtract(b)


def union_all(a: DataFrame, b: DataFrame) -> DataFrame:
    """UNION ALL matched by column name (not position)."""
    return a.unionByName(b)


def distinct_keys(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*cols).distinct()


def top_k_rows(df: DataFrame, k: int, order: list, cols: list[str] | None = None) -> DataFrame:
    """First ``k`` rows by a total order (per-partition top-k, then merge)."""
    out = df.orderBy(*order).limit(k)
    return out.select(*cols) if cols else out
