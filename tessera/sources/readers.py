"""File and connector readers with declared schemas.

Malformed input never fails a job: JSON and CSV are read PERMISSIVE
(bad fields become null), and callers filter on the columns they need.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import path_to_hour


def read_text(spark: SparkSession, path: str, min_partitions: int | None = None) -> DataFrame:
    """Text lines as ``value``.  Gzip files are not splittable (one task per
    file); pass ``min_partitions`` to spread work over more tasks after the
    read."""
    df = spark.read.text(path)
    return df.repartition(min_partitions) if min_partitions else df


def read_compressed_lines(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """Text lines of a folder of gzip files, dealt evenly over the cluster.

    A gzip file is one split whatever its size.  Spark packs small files into
    tasks by their bytes; a file above its fair share cannot be packed, so when
    the listed sizes show one (or fewer files than tasks) the lines are dealt
    round-robin behind the decompression.  Only sizes are read to decide.
    """
    n = partitions or spark.sparkContext.defaultParallelism
    files, total, largest = spark.read.format("binaryFile").load(path).select("length") \
        .agg(F.count(F.lit(1)), F.sum("length"), F.max("length")).first()
    lines = spark.read.text(path)
    even = files >= n and largest * n <= 2 * total
    return lines if even else lines.repartition(n)


def read_json(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """JSON lines with a declared schema; a missing key is null and a
    malformed line yields all-null fields (then dropped by the caller)."""
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)


def read_csv(spark: SparkSession, path: str, schema: StructType, sep: str = ",",
             quote: str | None = None, header: bool = False) -> DataFrame:
    """CSV with a declared schema.  Predicates on its columns are pushed to
    the CSV reader (``spark.sql.csv.filterPushdown.enabled``)."""
    r = spark.read.schema(schema).option("sep", sep).option("header", header) \
             .option("mode", "PERMISSIVE")
    if quote is not None:
        r = r.option("quote", quote)
    return r.csv(path)


def read_pagecounts(spark: SparkSession, path: str, schema: StructType,
                    hour_from_file: bool = False) -> DataFrame:
    """Space-delimited page counts.  Quoting is off (a title may start with a
    quote character).  With ``hour_from_file`` the hour comes from the
    source file name (null when the name has no ``pagecounts-`` stamp)."""
    df = read_csv(spark, path, schema, sep=" ", quote="")
    if hour_from_file:
        df = df.withColumn("hour", path_to_hour(F.col("_metadata.file_path")))
    return df


def with_source_file(df: DataFrame, out: str = "source_file") -> DataFrame:
    return df.withColumn(out, F.col("_metadata.file_path"))


def read_table(spark: SparkSession, fmt: str = "parquet", path: str | None = None,
               **options) -> DataFrame:
    """Generic table read: ``parquet`` here; a keyed store such as Cassandra
    is ``fmt='org.apache.spark.sql.cassandra', table=..., keyspace=...``
    (its connector jar must be on the classpath)."""
    r = spark.read.format(fmt).options(**options)
    return r.load(path) if path else r.load()
