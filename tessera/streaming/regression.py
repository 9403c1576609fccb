"""Running least-squares slope/intercept over a stream of ``"x y"`` points.

Source: any ``readStream`` format giving a text ``value`` (Kafka's binary
value is cast to string; files are read as text).  The state is one row of
running central moments (a global streaming aggregate, ``update`` mode).  Each
micro-batch result is written by ``foreachBatch`` to ``<out>/batch_id=<n>``
with overwrite, so a batch replayed after a failure rewrites the same
folder instead of adding rows; the checkpoint makes a restart resume from
the last committed offsets, never counting a point twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.stats import ols


def parse_points(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """``"x y"`` -> (x double, y double); malformed text gives nulls, which
    the fit skips."""
    parts = F.split(F.col(value_col).cast("string"), " ")
    return lines.select(parts.getItem(0).try_cast("double").alias("x"),
                        F.get(parts, 1).try_cast("double").alias("y"))


def running_fit(points: DataFrame) -> DataFrame:
    """Global running fit -> (n, slope, intercept); works on batch frames too.
    The state holds means and central moments, never raw sums of squares."""
    return ols(points, "x", "y")


def start_regression_stream(spark: SparkSession, source_format: str, options: dict,
                            out_dir: str | None, checkpoint_dir: str, path: str | None = None,
                            available_now: bool = True, sink: str = "batches"):
    """Start the stream; returns the StreamingQuery.

    ``available_now`` processes what is there in bounded micro-batches and
    stops; otherwise the query runs until ``stop()``.  ``sink='batches'``
    writes each batch result under ``out_dir``; ``'console'`` or
    ``'memory'`` use Spark's own sinks (``update`` mode either way).
    """
    reader = spark.readStream.format(source_format).options(**options)
    lines = reader.load(path) if path else reader.load()
    if "value" not in lines.columns:
        raise ValueError("stream source must provide a 'value' column")
    fit = running_fit(parse_points(lines))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_dir}/batch_id={batch_id}")

    w = fit.writeStream.outputMode("update").option("checkpointLocation", checkpoint_dir)
    if sink == "batches":
        w = w.foreachBatch(write_batch)
    else:
        w = w.format(sink).queryName("regression") if sink == "memory" else w.format(sink)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="5 seconds")
    return w.start()


def latest_result(spark: SparkSession, out_dir: str) -> DataFrame:
    """The result of the last committed micro-batch."""
    res = spark.read.parquet(out_dir)
    last = res.agg(F.max("batch_id")).scalar()
    return res.where(F.col("batch_id") == last).drop("batch_id")


def run_file_stream(spark: SparkSession, text_dir: str, out_dir: str, checkpoint_dir: str,
                    files_per_batch: int = 64, timeout_s: float | None = None) -> DataFrame:
    """Run the stream over a folder of text files to completion and return
    the final (n, slope, intercept).

    There is no time limit unless one is given; a stream that is still
    running when it ends is stopped and ``TimeoutError`` is raised, so a
    partial fit is never returned.
    """
    q = start_regression_stream(spark, "text", {"maxFilesPerTrigger": str(files_per_batch)},
                                out_dir, checkpoint_dir, path=text_dir)
    try:
        ended = q.awaitTermination() if timeout_s is None else q.awaitTermination(timeout_s)
    finally:
        if q.isActive:
            q.stop()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    if timeout_s is not None and not ended:
        raise TimeoutError(f"the stream was not done after {timeout_s} s")
    return latest_result(spark, out_dir)
