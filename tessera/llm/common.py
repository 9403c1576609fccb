"""Small Spark helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, scratch_path
from ..sources.tables import load

__all__ = ["MAX_ID", "cores", "documents", "load", "ship", "shuffle_partitions", "small_side", "stored", "tokenizer_file"]

MAX_ID = 2**63 - 1


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer's file: in the folder ``TOKENIZER_DIR``
    names, else where the ``public_tokenizers`` package has it."""
    if folder := os.environ.get("TOKENIZER_DIR"):
        return os.path.join(folder, name)
    import public_tokenizers
    return public_tokenizers.path(name)


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package (once per context), so
    that a job doesn't depend on where the driver was started."""
    sc = spark.sparkContext
    if getattr(sc, "_tessera_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    path = os.path.join(tempfile.mkdtemp(prefix="tessera-py-"), "tessera_pkg.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(os.path.join(root, "tessera")):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    sc._tessera_shipped = True


def documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just (doc_id bigint, text string): any further column, whatever its
    name, never reaches an operator."""
    ship(docs.sparkSession)
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def cores(spark: SparkSession) -> int:
    return spark.sparkContext.defaultParallelism


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back: the result survives lost executors and its lineage is cut."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


BROADCAST_BYTES = 32 << 20


def small_side(df: DataFrame, row_bytes: int, *binary: str) -> DataFrame:
    """A stored table, with a broadcast hint if its measured size allows: rows
    of ``row_bytes`` fixed bytes plus the lengths of the ``binary`` columns."""
    width = F.lit(row_bytes)
    for c in binary:
        width = width + F.coalesce(F.octet_length(c), F.lit(0))
    size = df.agg(F.sum(width)).first()[0] or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df
