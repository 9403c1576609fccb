"""Cache control: a frame held in memory or on disk for a block of work.

Use it where several short jobs read one frame.  What is lost with an executor
is computed again from the lineage; results that must not be (or that are read
long after) belong in ``joins.materialize``, which writes them to the shared
folder.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame


@contextmanager
def held(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """``df`` cached at ``level`` inside the block, and released at its end
    whatever happens there.  Partitions are cached as jobs first compute them."""
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist(blocking=True)


def held_bytes(df: DataFrame) -> tuple[int, int]:
    """(bytes in memory, bytes on disk) that the cached frame takes now."""
    plan = df.sparkSession._jsparkSession.sharedState().cacheManager().lookupCachedData(df._jdf)
    if plan.isEmpty():
        return 0, 0
    rdd = plan.get().cachedRepresentation().cacheBuilder().cachedColumnBuffers().id()
    infos = df.sparkSession.sparkContext._jsc.sc().getRDDStorageInfo()
    return next(((i.memSize(), i.diskSize()) for i in infos if i.id() == rdd), (0, 0))
