"""A stream of keyed rows merged into a keyed table, each batch exactly once.

``foreachBatch`` may hand over a batch again after a failure: between the
commit of the table and that of the stream's own progress.  The table's
manifest holds the last batch id of each writer, switched together with the
rows, so a batch that comes again is skipped and one that died half-way is
merged from the start.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..operators.keyed import KeyedTable


def merge_batches(root: str, writer: str):
    """A ``foreachBatch`` function: upserts the batch into the table at
    ``root`` under the writer's name, unless that batch has been applied."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        KeyedTable(batch.sparkSession, root).upsert(batch, writer=writer, batch=batch_id)

    return merge


def start_upsert_stream(rows: DataFrame, root: str, writer: str, checkpoint_dir: str, available_now: bool = True):
    """Merges a streaming frame into the table; returns the StreamingQuery.
    ``writer`` names this stream in the manifest: keep it (and the checkpoint
    folder) over restarts, and use one name for one stream."""
    w = rows.writeStream.foreachBatch(merge_batches(root, writer)).option("checkpointLocation", checkpoint_dir)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="5 seconds")).start()


def upsert_file_stream(spark: SparkSession, path: str, schema: StructType, root: str, writer: str,
                       checkpoint_dir: str, files_per_batch: int = 64) -> DataFrame:
    """Merges every Parquet file of a folder that has not been read before,
    in batches of files, and returns the table."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    q = start_upsert_stream(rows, root, writer, checkpoint_dir)
    try:
        q.awaitTermination()
    finally:
        if q.isActive:
            q.stop()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return KeyedTable(spark, root).read()
