"""Sinks: text lines, JSON-array lines, CSV/JSON folders, split outputs.

Writers sort only where the output format promises an order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .functions.text import format_count_line


def write_count_lines(df: DataFrame, path: str, word: str = "word", count: str = "count",
                      sort: bool = True) -> None:
    """``'%s %i'`` lines, sorted by word (range-partitioned sort)."""
    out = df.orderBy(word) if sort else df
    out.select(format_count_line(F.col(word), F.col(count)).alias("value")) \
       .write.mode("overwrite").text(path)


def write_tab_separated(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("sep", "\t").option("quote", "").csv(path)


def write_json_arrays(df: DataFrame, path: str) -> None:
    """One JSON array per row (the original's tuple dump)."""
    parts = [F.regexp_extract(F.to_json(F.array(F.col(c))), r"^\[(.*)\]$", 1) for c in df.columns]
    df.select(F.concat(F.lit("["), F.concat_ws(", ", *parts), F.lit("]")).alias("value")) \
      .write.mode("overwrite").text(path)


def write_json(df: DataFrame, path: str, gzip: bool = False) -> None:
    w = df.write.mode("overwrite")
    if gzip:
        w = w.option("compression", "gzip")
    w.json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path)


def write_split(pos: DataFrame, neg: DataFrame, path: str, fmt: str = "json") -> None:
    """Two outputs in ``positive`` / ``negative`` sub-folders."""
    pos.write.mode("overwrite").format(fmt).save(f"{path}/positive")
    neg.write.mode("overwrite").format(fmt).save(f"{path}/negative")


def write_split_once(df: DataFrame, positive: Column, path: str, fmt: str = "json") -> None:
    """The same two outputs in one pass over ``df``: sub-folders
    ``side=positive`` and ``side=negative``; rows where the condition is null
    are in neither."""
    side = F.when(positive, F.lit("positive")).otherwise(F.lit("negative")).alias("side")
    df.where(positive.isNotNull()).select("*", side).write.mode("overwrite").partitionBy("side").format(fmt).save(path)


def write_path(path_df: DataFrame, path: str) -> None:
    """Shortest path as text, one node per line in step order (at most
    max_hops + 1 rows, so a single file is fine)."""
    path_df.orderBy("step").select(F.col("node").cast("string").alias("value")) \
           .coalesce(1).write.mode("overwrite").text(path)


def write_table(df: DataFrame, fmt: str = "parquet", path: str | None = None,
                mode: str = "overwrite", **options) -> None:
    """Generic table write (the keyed-store overwrite of the log loader).

    A keyed store such as Cassandra is ``fmt='org.apache.spark.sql.cassandra',
    table=..., keyspace=..., **{'confirm.truncate': 'true'}`` (connector jar
    required); here Parquet.
    """
    w = df.write.mode(mode).format(fmt).options(**options)
    w.save(path) if path else w.save()
