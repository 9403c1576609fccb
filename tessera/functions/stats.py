"""Correlation and least squares from central moments.

Spark's ``covar_pop``, ``regr_slope`` and ``regr_intercept`` keep running means and
central moments (merged pairwise), so neither large values nor large offsets
cancel or overflow, and they also run on streams.  Results are rounded to
``DIGITS`` significant digits, past which partitioning may show.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIGITS = 9


def significant(c: Column) -> Column:
    """Rounded to ``DIGITS`` significant digits (null stays null)."""
    return F.when(c.isNotNull(), F.format_string(f"%.{DIGITS - 1}e", c).cast("double") + F.lit(0.0))


def _points(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")) \
             .where(F.col("x").isNotNull() & F.col("y").isNotNull())


def pearson(df: DataFrame, x: str, y: str) -> DataFrame:
    """One row (n, r, r2); rows with a null are skipped, r is null where x or y is constant."""
    spread = F.stddev_pop("x") * F.stddev_pop("y")
    m = _points(df, x, y).agg(F.count(F.lit(1)).alias("n"),
                              F.try_divide(F.covar_pop("x", "y"), spread).alias("r"))
    return m.select("n", significant(F.col("r")).alias("r"), significant(F.col("r") * F.col("r")).alias("r2"))


def ols(df: DataFrame, x: str, y: str) -> DataFrame:
    """One row (n, slope, intercept); both null without rows or with a constant x."""
    m = _points(df, x, y).agg(F.count(F.lit(1)).alias("n"), F.regr_slope("y", "x").alias("slope"),
                              F.regr_intercept("y", "x").alias("intercept"))
    return m.select("n", significant(F.col("slope")).alias("slope"),
                    significant(F.when(F.col("slope").isNotNull(), F.col("intercept"))).alias("intercept"))
