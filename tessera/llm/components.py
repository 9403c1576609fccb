"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

MAX_ROUNDS = 60


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction of directed edges (u, v), u > v.

    Large star: each node's larger neighbours are linked to its smallest one
    (or itself).  Small star: each node and its smaller neighbours are linked
    to the smallest.
    """
    if large:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        out = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        out = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
                   .union(least.select("u", F.col("m").alias("v")))
    return out.where(F.col("u") != F.col("v")).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links(a, b)``; the component is
    the smallest node reachable.  Nodes without links are absent.

    Each round is a few shuffles over the links, written to the shared
    checkpoint folder; only the count and a checksum reach the driver.  Raises
    if the rounds do not settle.
    """
    edges = links.where(F.col("a") != F.col("b")) \
                 .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = stored(edges, "edges")
    before = None
    for _ in range(MAX_ROUNDS):
        edges = stored(_star(_star(edges, True), False), "edges")
        state = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == before or not state[0]:
            roots = edges.select(F.col("v").alias("node")).distinct()
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")) \
                        .union(roots.select("node", F.col("node").alias("component")))
        before = state
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
