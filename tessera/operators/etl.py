"""Filter / project ETL jobs (comment split and station observations)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def comment_split(df: DataFrame, group: str = "subreddit", score: str = "score",
                  author: str = "author", contains: str = "e", threshold: float = 0):
    """Project (group, score, author), keep groups containing ``contains``,
    and split into ``score > threshold`` and ``score <= threshold``.

    Returns ``(positive, non_positive)``; a null score is in neither.
    Callers writing both outputs should cache the projected frame once.
    """
    base = df.select(group, score, author).where(F.col(group).contains(contains))
    return (base.where(F.col(score) > threshold), base.where(F.col(score) <= threshold))


def weather_etl(df: DataFrame, station_prefix: str = "CA", observation: str = "TMAX",
                scale: float = 10.0) -> DataFrame:
    """Unflagged observations of one kind for stations with a prefix, value/10.

    Every predicate is a plain comparison on a source column, so on a
    parquet/CSV source all of them reach the scan as pushed filters.
    """
    return (df.where(F.col("qflag").isNull()
                     & F.col("station").startswith(station_prefix)
                     & (F.col("observation") == observation))
              .select("station", "date", (F.col("value") / F.lit(scale)).alias("tmax")))
