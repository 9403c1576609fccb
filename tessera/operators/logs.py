"""Web-log load, per-host totals, correlation of requests and bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.logs import log_fields, log_time
from ..functions.stats import pearson
from .partitioning import spread


def parse_log_lines(df: DataFrame, line_col: str = "value", seq_col: str | None = None,
                    with_id: bool = True, min_partitions: int | None = None,
                    id_mode: str = "stable") -> DataFrame:
    """Lines -> (host, datetime, path, bytes[, id]); non-matching lines are dropped.

    ``id`` replaces the original random UUID with a stable key:
    ``sha2(seq | line)``, so re-running a load upserts instead of
    duplicating.  ``seq_col`` (a line number) tells identical lines apart.
    ``id_mode='random'`` gives the original per-row ``uuid()`` instead.
    ``min_partitions`` spreads few-split input (e.g. gzip files, one task
    each) before the regex work, like the original's ``repartition(80)``.
    """
    if min_partitions:
        df = spread(df, min_partitions)
    line = F.col(line_col)
    keep = [seq_col, line_col] if seq_col else [line_col]
    fields = df.select(*keep, log_fields(line).alias("_f"))
    # inline() of a one-element array (or of null for a rejected line) drops
    # rejected lines inside the generator.  A Filter here would be pushed
    # below the projection by the optimizer, which inlines (and so repeats)
    # the regex once per referenced field.
    f = F.col("_f")
    parsed_row = F.struct(f[0].alias("host"), log_time(f[1]).alias("datetime"),
                          f[2].alias("path"), f[3].try_cast("bigint").alias("bytes"))
    parsed = fields.select(*keep, F.inline(F.when(F.size(f) == 4, F.array(parsed_row)))) \
                   .where(F.col("datetime").isNotNull() & F.col("bytes").isNotNull())
    cols = ["host", "datetime", "path", "bytes"]
    if with_id:
        if id_mode == "random":
            parsed = parsed.withColumn("id", F.expr("uuid()"))
        else:
            key = F.concat_ws("|", F.col(seq_col).cast("string"), line) if seq_col else line
            parsed = parsed.withColumn("id", F.sha2(key, 256))
        cols.append("id")
    return parsed.select(*cols)


def rejected_lines(df: DataFrame, line_col: str = "value") -> DataFrame:
    """Lines the parser drops (no match, bad time, bytes not a number), so a
    load can count or keep its rejects instead of failing on them."""
    fields = df.select(line_col, log_fields(F.col(line_col)).alias("_f"))
    f = F.col("_f")
    ok = F.when(F.size(f) == 4, log_time(f[1]).isNotNull() & f[3].try_cast("bigint").isNotNull()) \
          .otherwise(F.lit(False))
    # same generator form as the parser: one regex pass, no pushed-down filter
    return fields.select(F.inline(F.when(~ok, F.array(F.struct(F.col(line_col).alias(line_col))))))


def host_totals(logs: DataFrame, host: str = "host", nbytes: str = "bytes") -> DataFrame:
    """(host, requests, bytes) per host; partial aggregation before the shuffle."""
    return logs.groupBy(host).agg(F.count(F.lit(1)).alias("requests"),
                                  F.sum(nbytes).cast("bigint").alias("bytes"))


def log_correlation(totals: DataFrame, x: str = "requests", y: str = "bytes") -> DataFrame:
    """One row (n, r, r2): Pearson r of requests vs bytes over hosts.

    The six sums are exact decimals, so only the final sqrt/divide rounds;
    a single host or a constant column gives null (no divide by zero).
    """
    return pearson(totals, x, y)


def total_bytes(logs: DataFrame, nbytes: str = "bytes") -> DataFrame:
    return logs.agg(F.sum(nbytes).cast("bigint").alias("total_bytes"))
