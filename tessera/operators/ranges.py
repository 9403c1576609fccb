"""Daily temperature-range leader: station(s) with the largest TMAX-TMIN per date.

Joining every TMAX row with every TMIN row of the same station and date and
keeping the pairs whose range is the date's maximum gives one row per pair.
Here a leader is one row with its number of ``pairs``; ``repeat=True``
repeats it that often, as the pair join would.

Plan: one scan and one hash aggregate count the (station, date, observation,
value) combinations; a second one takes both extremes and their counts per
(station, date).  That table is stored once; the per-date maximum is a small
aggregate of it joined back.  No step enumerates pairs within a key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .joins import broadcast_if_small, materialize


def station_ranges(obs: DataFrame, scale: float = 10.0) -> DataFrame:
    """(station, date, range, pairs) of every station and date with both observations."""
    clean = obs.where(F.col("qflag").isNull() & F.col("value").isNotNull()
                      & F.col("observation").isin("TMAX", "TMIN"))
    per_value = clean.groupBy("station", "date", "observation", "value").agg(F.count(F.lit(1)).alias("_n"))
    high = F.when(F.col("observation") == "TMAX", F.col("value"))
    low = F.when(F.col("observation") == "TMIN", F.col("value"))
    ends = per_value.groupBy("station", "date").agg(
        F.max(high).alias("_hi"), F.max_by("_n", high).alias("_n_hi"),
        F.min(low).alias("_lo"), F.min_by("_n", low).alias("_n_lo"))
    return ends.where("_hi IS NOT NULL AND _lo IS NOT NULL").select(
        "station", "date", ((F.col("_hi") - F.col("_lo")) / F.lit(scale)).alias("range"),
        (F.col("_n_hi") * F.col("_n_lo")).alias("pairs"))


def range_leader(obs: DataFrame, scale: float = 10.0, repeat: bool = False) -> DataFrame:
    """(date, station, range, pairs) of every leader; ``obs`` has station,
    date, observation, value, qflag.  ``repeat`` gives (date, station, range)
    once per pair instead."""
    best = materialize(station_ranges(obs, scale))
    per_date = best.groupBy(F.col("date").alias("_d")).agg(F.max("range").alias("_max"))
    # one row per date: broadcast after a size check, else a stored side
    # that AQE can skew-split when one date holds most stations
    per_date, _ = broadcast_if_small(per_date)
    leaders = best.join(per_date, (F.col("date") == F.col("_d")) & (F.col("range") == F.col("_max"))) \
                  .select("date", "station", "range", "pairs")
    return repeat_rows(leaders, "pairs").drop("pairs") if repeat else leaders


# Rows are re-created in blocks so no generated array exceeds this length.
_BLOCK = 4096


def repeat_rows(df: DataFrame, times: str) -> DataFrame:
    """Each row ``times`` times (0 -> dropped), generated in blocks of at most
    4096 so a large multiplicity never builds one huge array."""
    n = F.col(times).cast("long")
    blocks = df.where(n > 0).select("*", F.explode(F.sequence(F.lit(0).cast("long"),
                                                 F.ceil(n / _BLOCK).cast("long") - 1)).alias("_blk"))
    size = F.least(F.lit(_BLOCK).cast("long"), n - F.col("_blk") * _BLOCK).cast("int")
    return (blocks.select("*", F.explode(F.array_repeat(F.lit(1), size)).alias("_one"))
                  .drop("_blk", "_one"))


RANGE_LEADER_SQL = """
WITH per_value AS (
  SELECT station, date, observation, value, count(*) AS n FROM {obs}
  WHERE qflag IS NULL AND value IS NOT NULL AND observation IN ('TMAX', 'TMIN')
  GROUP BY station, date, observation, value
),
ends AS (
  SELECT station, date,
         max(CASE WHEN observation = 'TMAX' THEN value END) AS hi,
         max_by(n, CASE WHEN observation = 'TMAX' THEN value END) AS n_hi,
         min(CASE WHEN observation = 'TMIN' THEN value END) AS lo,
         min_by(n, CASE WHEN observation = 'TMIN' THEN value END) AS n_lo
  FROM per_value GROUP BY station, date
)
SELECT station, date, (hi - lo) / {scale}D AS range, n_hi * n_lo AS pairs
FROM ends WHERE hi IS NOT NULL AND lo IS NOT NULL
"""

LEADER_SQL = """
WITH per_date AS (SELECT date AS d, max(range) AS max_range FROM {best} GROUP BY date)
SELECT date, station, range, pairs
FROM {best} AS b JOIN per_date ON b.date = per_date.d AND b.range = per_date.max_range
ORDER BY date, station
"""


def range_leader_sql(spark: SparkSession, obs: DataFrame, scale: float = 10.0) -> DataFrame:
    """The same two steps as Spark SQL text (frames bound as views), sorted
    by date and station."""
    best = materialize(spark.sql(RANGE_LEADER_SQL, obs=obs, scale=float(scale)))
    return spark.sql(LEADER_SQL, best=best)
