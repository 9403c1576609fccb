"""Shortest path between two nodes, searched from both ends.

Two frontiers grow hop by hop, the smaller one next: from the source along the
links, from the destination against them.  They meet after as many hops as the
distance, having visited about twice the square root of what a search from one
end visits.  Each side keeps (node, parent) by distance, not paths; links are
stored once per direction, bucketed by the end that is looked up, and hot ends
apart (``graph.Links``), so no hop shuffles them.

The path is the one a search from the source alone gives: every node's parent
is the smallest node one hop nearer to the source.  Behind the meeting level
those parents are found by going forward from the nodes where the sides met,
through the levels of the destination's side only.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ..session import delete_path, scratch_path
from .graph import Links, bucketed, clean_edges

PATH_SCHEMA = StructType([StructField("step", IntegerType(), False), StructField("node", LongType(), False)])
LEVEL_SCHEMA = StructType([StructField("node", LongType(), False), StructField("parent", LongType()),
                           StructField("distance", IntegerType(), False)])


class _Side:
    """One frontier: its links, and every node it knows by distance."""

    def __init__(self, edges: DataFrame, start: int, buckets: int | None):
        spark = edges.sparkSession
        self.spark, self.links, self.hops, self.known, self.frontier = spark, Links(edges, buckets), 0, 1, 1
        self.name, self.path = f"tessera_side_{uuid.uuid4().hex[:12]}", scratch_path(spark, "side")
        first = spark.createDataFrame([(start, None, 0)], LEVEL_SCHEMA)
        bucketed(first, self.name, "node", self.links.buckets, self.path, partition_by="distance")

    def level(self, distance: int) -> DataFrame:
        return self.spark.table(self.name).where(F.col("distance") == distance).select("node", "parent")

    def grow(self) -> int:
        """Adds the next level and returns its size."""
        reached = self.links.reach(self.level(self.hops).select("node")) \
                      .groupBy(F.col("_dst").alias("node")).agg(F.min("node").alias("parent"))
        new = reached.join(self.spark.table(self.name).select("node"), "node", "left_anti") \
                     .select("node", "parent", F.lit(self.hops + 1).alias("distance"))
        seen = Observation(f"{self.name}-{self.hops + 1}")
        bucketed(new.observe(seen, F.count(F.lit(1)).alias("n")), self.name, "node", self.links.buckets, partition_by="distance")
        self.hops += 1
        self.frontier = seen.get["n"]
        self.known += self.frontier
        return self.frontier

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        delete_path(self.spark, self.path)
        self.links.drop()


def _forward_levels(near: _Side, far: _Side) -> list[DataFrame]:
    """(node, parent) of the path candidates at each distance behind the
    meeting level, stored: the last holds the destination alone."""
    spark, levels = near.spark, []
    now = near.level(near.hops).join(far.level(far.hops).select("node"), "node", "left_semi").select("node")
    for left in range(far.hops - 1, -1, -1):
        step = near.links.reach(now).join(far.level(left).select(F.col("node").alias("_dst")), "_dst", "left_semi") \
                   .groupBy(F.col("_dst").alias("node")).agg(F.min("node").alias("parent"))
        path = scratch_path(spark, "forward")
        step.write.parquet(path)
        levels.append(spark.read.schema("node bigint, parent bigint").parquet(path))
        now = levels[-1].select("node")
    return levels


def path_between(edges: DataFrame, source: int, destination: int, max_hops: int = 6, src_col: str = "source",
                 dst_col: str = "node", buckets: int | None = None) -> tuple[DataFrame, int]:
    """``(path, visited)``: (step, node) rows from the source (step 0) to the
    destination, and how many nodes both sides came to know.

    There are no rows if the destination is more than ``max_hops`` away or not
    reachable; source and destination may be the same node (one row), or in
    no edge.  Repeated edges, loops and rows with a null end change nothing.
    """
    spark = edges.sparkSession
    source, destination = int(source), int(destination)
    if source == destination:
        return spark.createDataFrame([(0, source)], PATH_SCHEMA), 1
    links = clean_edges(edges, src_col, dst_col)
    near = _Side(links, source, buckets)
    far = _Side(links.select(F.col("_dst").alias("_src"), F.col("_src").alias("_dst")), destination, buckets)
    try:
        met = False
        while not met and near.hops + far.hops < max_hops:
            if not (near if near.frontier <= far.frontier else far).grow():
                break
            met = bool(near.level(near.hops).join(far.level(far.hops).select("node"), "node", "left_semi").limit(1).count())
        known = near.known + far.known
        if not met:
            return spark.createDataFrame([], PATH_SCHEMA), known
        behind = _forward_levels(near, far)
        nodes = [destination]  # at most max_hops + 1 ids
        for level in reversed([near.level(i) for i in range(1, near.hops + 1)] + behind):
            nodes.append(level.where(F.col("node") == nodes[-1]).first()["parent"])
        return spark.createDataFrame(list(enumerate(reversed(nodes))), PATH_SCHEMA), known
    finally:
        near.drop()
        far.drop()
