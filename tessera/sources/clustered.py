"""Storage-side filters: a stored copy laid out so that scans skip data.

The copy is range-partitioned and sorted by its filter columns, so each row
group holds a narrow range of them and its minimum and maximum rule it out for
most predicates (prefixes and ranges too).  Columns filtered by equality that
the sort doesn't separate get a Parquet Bloom filter per row group.  A range of
one hot key is cut by the columns that follow it in the order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

ROW_GROUP_BYTES = 32 << 20


def write_clustered(df: DataFrame, path: str, order: list[str], bloom: tuple[str, ...] = (),
                    partitions: int | None = None, row_group_bytes: int = ROW_GROUP_BYTES) -> None:
    """Writes ``df`` as Parquet, range-partitioned and sorted by ``order``.
    The number of partitions is left to AQE unless given."""
    dealt = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    w = dealt.sortWithinPartitions(*order).write.mode("errorifexists").option("parquet.block.size", row_group_bytes)
    for c in bloom:
        w = w.option(f"parquet.bloom.filter.enabled#{c}", "true")
    w.parquet(path)


def rows_scanned(df: DataFrame) -> int:
    """Runs ``df`` (a scan with filters and projections) and returns how many
    rows its scans handed on, by Spark's own metric."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(int(leaves.apply(i).metrics().apply("numOutputRows").value()) for i in range(leaves.size()))
