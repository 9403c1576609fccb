"""Largest value per group: one winner, the value only, all ties, tie list.

All four start from a hash aggregate of the fixed-width value with map-side
partial maxima, so a group holding a third of the rows is reduced before any
shuffle; only rows that reach the maximum go on.  The
tie-keeping forms join the (small) per-group maxima back to the rows; the
maxima side is broadcast only after its row count has been checked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import broadcast_if_small


def page_filter(df: DataFrame, language: str = "en", main_page: str = "Main_Page",
                special_prefix: str = "Special:", lang_col: str = "language",
                title_col: str = "title") -> DataFrame:
    """Keep one language, drop the main page and titles with a given prefix.

    A null title fails the prefix test and is dropped, as in the original.
    """
    t = F.col(title_col)
    return df.where((F.col(lang_col) == language) & (t != main_page)
                    & (~t.startswith(special_prefix)))


def max_by_group_one(df: DataFrame, group: str, value: str, tie: str) -> DataFrame:
    """One winner per group: the max of ``(value, tie)``; ties go to the largest
    ``tie``, resolved among the rows that reach the maximum."""
    ties = max_by_group_ties(df, group, value, [tie])
    return ties.groupBy(group, value).agg(F.max(tie).alias(tie))


def max_by_group_value(df: DataFrame, group: str, value: str, floor: int | None = 0) -> DataFrame:
    """Largest value per group; with ``floor`` the result is never below it."""
    m = F.max(value)
    if floor is not None:
        m = F.greatest(m, F.lit(floor))
    return df.groupBy(group).agg(m.alias(value))


def group_maxima(df: DataFrame, group: str, value: str) -> DataFrame:
    return df.groupBy(group).agg(F.max(value).alias("_max"))


def max_by_group_ties(df: DataFrame, group: str, value: str, keep: list[str],
                      check_broadcast: bool = True) -> DataFrame:
    """Every row that reaches its group's maximum (ties kept).

    The join condition ``value == max`` becomes a second equi-join key, so
    the per-group maxima side is small (one row per group).
    """
    maxima = group_maxima(df, group, value).withColumnRenamed(group, "_g")
    if check_broadcast:
        maxima, _ = broadcast_if_small(maxima)
    j = df.join(maxima, (F.col(group) == F.col("_g")) & (F.col(value) == F.col("_max")))
    return j.select(group, *keep, value)


def max_by_group_list(df: DataFrame, group: str, value: str, item: str,
                      sep: str = ",") -> DataFrame:
    """Per group: the maximum and the sorted, ``sep``-joined list of items reaching it.

    The list is the output itself; it is gathered with partial aggregation
    (per-task lists are merged), never by shipping a whole group at once.
    """
    ties = max_by_group_ties(df, group, value, [item])
    return (ties.groupBy(group)
                .agg(F.max(value).alias(value),
                     F.array_join(F.array_sort(F.collect_list(item)), sep).alias(item + "s")))
