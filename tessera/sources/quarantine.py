"""Good rows and a quarantine of malformed lines, from one scan.

A malformed line never fails a load, and is never lost: it goes to the
quarantine with its file, its text and the reason.  Lines are parsed once, by
Spark's JSON or CSV parser, and written in one pass to two folders, ``ok=true``
and ``ok=false``; both results read those.  Reasons, the first that holds:

    malformed         not a JSON object, or not the declared number of fields
    wrong type: c     a value of column c that its type cannot hold
    missing: c        a required column that is null or absent
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..session import scratch_path

CORRUPT = "_corrupt"


def _parsed(fmt: str, line: Column, schema: StructType, options: dict) -> tuple[Column, Column, Column]:
    """(typed struct, the same with every value as text, or null; malformed)."""
    text = StructType([StructField(f.name, StringType()) for f in schema])
    corrupt = StructField(CORRUPT, StringType())
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, **options}
    if fmt == "json":
        typed, raw = (F.from_json(line, StructType([*s, corrupt]), options) for s in (schema, text))
        bad = F.coalesce(raw[CORRUPT].isNotNull(), F.lit(True)) | ~F.trim(line).startswith("{")
    elif fmt == "csv":
        # from_csv takes its schema as text
        typed, raw = (F.from_csv(line, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*s, corrupt]), options)
                      for s in (schema, text))
        bad = raw[CORRUPT].isNotNull()
    else:
        raise ValueError(f"format is json or csv, not {fmt!r}")
    return typed, raw, bad


def split_lines(spark: SparkSession, path: str, fmt: str, schema: StructType, required: tuple[str, ...] = (),
                options: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """``(good, quarantine)``: rows of ``schema``, and (file, line, reason).

    Blank lines are neither.  Lines are separated as Spark's text source does
    it, so a quoted CSV field may not hold a line end.  Every good line gives
    one row, whatever its further JSON keys.
    """
    line = F.col("value")
    typed, raw, bad = _parsed(fmt, line, schema, options or {})
    seen = spark.read.text(path).where(F.trim(line) != "").select(
        F.col("_metadata.file_path").alias("file"), line.alias("line"), typed.alias("typed"), raw.alias("raw"), bad.alias("bad"))
    reason = F.when(F.col("bad"), "malformed")
    for f in schema:
        held = F.col("raw")[f.name].isNotNull()
        if not isinstance(f.dataType, StringType):
            reason = reason.when(held & F.col("typed")[f.name].isNull(), f"wrong type: {f.name}")
        if f.name in required:
            reason = reason.when(~held, f"missing: {f.name}")
    judged = seen.withColumn("reason", reason)
    ok = F.col("reason").isNull()
    values = F.struct(*[F.col("typed")[f.name].alias(f.name) for f in schema])
    out = scratch_path(spark, f"{fmt}-lines")
    judged.select(F.when(ok, values).alias("row"), F.when(~ok, F.col("file")).alias("file"),
                  F.when(~ok, F.col("line")).alias("line"), "reason", ok.alias("ok")) \
          .write.partitionBy("ok").parquet(out)
    stored = spark.read.schema(StructType([StructField("row", schema), *[StructField(c, StringType()) for c in (
        "file", "line", "reason")]]).add("ok", "boolean")).parquet(out)
    return stored.where("ok").select("row.*"), stored.where("NOT ok").select("file", "line", "reason")
