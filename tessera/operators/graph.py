"""Link graphs: adjacency text -> edges, bounded BFS, shortest path.

BFS runs one hop per iteration as DataFrame joins over two tables written
once into the shared checkpoint folder and bucketed by node id:

  edges    (_src, _dst)  bucketed by _src  -- written once
  visited  (node, distance, parent, path), partitioned by distance and
           bucketed by node                -- each hop appends one partition

  frontier = visited WHERE distance = hop-1          (partition pruning)
  frontier JOIN edges ON node = _src                 (edges not shuffled;
            AQE broadcasts a small frontier)
  + hot sources (out-degree above an average bucket, at most #buckets of
    them) are kept in a separate plain table joined with the broadcast hot
    part of the frontier, so one hot node never becomes one huge task
  -> per reached node: min(parent)                    (hash aggregate, map-side
            combined); the parent's path is joined back from the frontier
  -> LEFT ANTI JOIN visited ON node                   (visited not shuffled)
  -> append as partition distance = hop

So a hop shuffles only the frontier and the reached candidates, never the
edge table or everything visited so far, and lineage is one hop deep (each
hop reads tables, not the previous hop's plan); a lost executor costs at
most the current hop.  The parent of a node is the smallest frontier node
reaching it at its distance and its path is the parent's path plus
itself, so distances, parents and paths are deterministic.  The tables are
registered for the search only: both catalog entries and the edge files are
dropped at its end, the visited files are the result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from ..session import delete_path, scratch_path
from .joins import materialize

VISITED_SCHEMA = StructType([
    StructField("node", LongType(), False), StructField("parent", LongType(), True),
    StructField("path", ArrayType(LongType(), False), False),
    StructField("distance", IntegerType(), False),
])


def edges_from_adjacency(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """``"node: n1 n2 ..."`` lines -> (source, node) rows.

    Empty tokens are skipped; lines without ``:`` or with a non-integer id
    are dropped (``try_cast``), instead of failing the job.
    """
    parts = F.split(F.col(line_col), ":", 2)
    src = F.trim(parts.getItem(0)).try_cast("bigint")
    outs = F.split(F.trim(parts.getItem(1)), " ", -1)
    e = lines.where(F.size(parts) == 2).select(src.alias("source"), F.explode(outs).alias("_t"))
    return (e.where(F.col("_t") != "")
             .select("source", F.col("_t").try_cast("bigint").alias("node"))
             .where(F.col("source").isNotNull() & F.col("node").isNotNull()))


BUCKET_BYTES = 128 << 20   # aimed size of one bucket of the edge table
EDGE_BYTES = 16            # two ids


def bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str | None = None,
              partition_by: str | None = None) -> None:
    """Create the table at ``path``, or append to it where none is given."""
    w = df.write.mode("errorifexists" if path else "append").bucketBy(buckets, key).sortBy(key)
    if partition_by:
        w = w.partitionBy(partition_by)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)


def clean_edges(edges: DataFrame, src_col: str = "source", dst_col: str = "node") -> DataFrame:
    """(_src, _dst) of the edges whose ends are both known."""
    return (edges.select(F.col(src_col).cast("bigint").alias("_src"),
                         F.col(dst_col).cast("bigint").alias("_dst"))
                 .where(F.col("_src").isNotNull() & F.col("_dst").isNotNull()))


class Links:
    """Distinct edges (_src, _dst) stored once for look-ups by ``_src``.

    Hot sources are those whose out-degree is above an average bucket (total /
    buckets).  There are at most ``buckets`` of them, so their id list is a
    proven-small broadcast.  Their edges are kept out of the bucketed table
    (where one source would make one huge bucket and one huge task every hop)
    and stored as a plain table that scans in size-balanced splits.
    """

    def __init__(self, e_all: DataFrame, buckets: int | None = None):
        spark = e_all.sparkSession
        self.spark, self.name, self.path = spark, f"tessera_edges_{uuid.uuid4().hex[:12]}", scratch_path(spark, "bfs-edges")
        deg = e_all.groupBy("_src").agg(F.count(F.lit(1)).alias("_deg"))
        total, top = deg.agg(F.sum("_deg"), F.max("_deg")).first()
        nb = buckets or max(spark.sparkContext.defaultParallelism, -(-(total or 0) * EDGE_BYTES // BUCKET_BYTES))
        self.buckets = nb
        limit = max(1, (total or 0) // nb)
        hot = None
        if (top or 0) > limit:
            hot = materialize(deg.where(F.col("_deg") > F.lit(limit)).select("_src"))
            if not hot.count():
                hot = None
        regular = e_all.join(F.broadcast(hot), "_src", "left_anti") if hot is not None else e_all
        # hash-partitioning on _src already clusters (_src, _dst), so distinct
        # adds no shuffle, and each task then writes exactly one bucket file
        bucketed(regular.repartition(nb, "_src").distinct(), self.name, "_src", nb, self.path)
        self.hot, self.hot_ids, self.hot_path = None, None, None
        if hot is not None:
            self.hot_path = scratch_path(spark, "bfs-hot-edges")
            e_all.join(F.broadcast(hot), "_src", "left_semi").distinct().write.parquet(self.hot_path)
            self.hot = spark.read.parquet(self.hot_path)
            self.hot_ids = F.broadcast(hot.withColumnRenamed("_src", "_hot"))

    def reach(self, frontier: DataFrame) -> DataFrame:
        """(node, _dst): every edge out of the frontier's nodes."""
        e = self.spark.table(self.name)
        pairs = frontier.join(e, frontier["node"] == e["_src"]).select("node", "_dst")
        if self.hot is None:
            return pairs
        # frontier nodes that are hot: at most as many as buckets -> broadcast
        f_hot = frontier.join(self.hot_ids, frontier["node"] == F.col("_hot"), "left_semi")
        return pairs.unionByName(F.broadcast(f_hot).join(self.hot, F.col("node") == self.hot["_src"]).select("node", "_dst"))

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        for path in filter(None, (self.path, self.hot_path)):
            delete_path(self.spark, path)


def bfs(edges: DataFrame, source: int, max_hops: int = 6, destination: int | None = None,
        src_col: str = "source", dst_col: str = "node", snapshot_dir: str | None = None,
        buckets: int | None = None):
    """Breadth-first search from ``source`` for at most ``max_hops`` hops.

    Returns ``(visited, hop_counts)``: visited is (node, parent, path,
    distance) with parent null for the source; hop_counts is a list of
    (hop, known nodes after the hop).  Stops early when a hop adds nothing
    or when ``destination`` has been reached.  With ``snapshot_dir`` the
    known nodes are written as CSV after every hop (``iter-<hop>``).
    ``buckets`` defaults to the measured edge bytes over ``BUCKET_BYTES``,
    and at least the cluster's cores.
    """
    spark: SparkSession = edges.sparkSession
    tag = uuid.uuid4().hex[:12]
    v_name, v_path = f"tessera_bfs_visited_{tag}", scratch_path(spark, "bfs-visited")
    links = Links(clean_edges(edges, src_col, dst_col), buckets)
    nb = links.buckets

    start = spark.createDataFrame([(int(source), None, [int(source)], 0)], VISITED_SCHEMA)
    bucketed(start, v_name, "node", nb, v_path, partition_by="distance")
    known = 1
    counts = [(0, known)]
    found = destination is not None and int(destination) == int(source)
    if snapshot_dir:
        _snapshot(spark.table(v_name), f"{snapshot_dir}/iter-0")
    for hop in range(1, max_hops + 1):
        if found:
            break
        visited = spark.table(v_name)
        frontier = visited.where(F.col("distance") == hop - 1)
        pairs = links.reach(frontier)
        reached = pairs.groupBy(F.col("_dst").alias("node")).agg(F.min("node").alias("parent"))
        paths = frontier.select(F.col("node").alias("_p"), F.col("path").alias("_path"))
        new = (reached.join(visited.select("node"), "node", "left_anti")
               .join(paths, F.col("parent") == F.col("_p"))
               .select("node", "parent", F.concat("_path", F.array("node")).alias("path"),
                       F.lit(hop).alias("distance")))
        # the hop's row count (and whether the destination arrived) are
        # observed while the rows are written: no separate counting job
        obs = Observation(f"bfs-hop-{tag}-{hop}")
        dest_hit = (F.col("node") == F.lit(destination)) if destination is not None else F.lit(False)
        new = new.observe(obs, F.count(F.lit(1)).alias("n"),
                          F.max(dest_hit.cast("int")).alias("hit"))
        bucketed(new, v_name, "node", nb, partition_by="distance")
        n_new = obs.get["n"]
        if n_new == 0:
            break
        known += n_new
        counts.append((hop, known))
        if snapshot_dir:
            _snapshot(spark.table(v_name), f"{snapshot_dir}/iter-{hop}")
        found = destination is not None and obs.get["hit"] == 1
    result = spark.read.schema(VISITED_SCHEMA).parquet(v_path)
    spark.sql(f"DROP TABLE IF EXISTS {v_name}")
    links.drop()
    return result, counts


def _snapshot(visited: DataFrame, path: str) -> None:
    visited.select("node", "parent", "distance").write.mode("overwrite").csv(path)


def path_to(visited: DataFrame, destination) -> DataFrame:
    """(step, node) from the source (step 0) to ``destination``; empty when
    the destination was not reached."""
    d = F.lit(destination) if not hasattr(destination, "alias") else destination
    return (visited.where(F.col("node") == d)
                   .select(F.posexplode("path").alias("step", "node")))


def shortest_path(edges: DataFrame, source: int, destination: int, max_hops: int = 6,
                  **kw) -> DataFrame:
    visited, _ = bfs(edges, source, max_hops=max_hops, destination=destination, **kw)
    return path_to(visited, destination)
