"""The purchase reports as Spark SQL text (CTEs, DISTINCT prefixes, IN-list).

Tables are bound with ``spark.sql(text, name=DataFrame)`` and string values
as named parameters (``:name``), so nothing is registered globally and no
value is pasted into the text; Catalyst plans the text exactly like the DataFrame
versions in ``operators.reports`` (AQE picks broadcast or shuffle joins at
runtime).  ``flags_view`` shows the named-view form (CREATE OR REPLACE TEMP
VIEW equivalent) for reuse across several statements.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

REGION_FLAG_SQL = """
WITH vprefixes AS (
  SELECT DISTINCT substring(n_name, 1, {prefix_len}) AS vp FROM {nation} WHERE n_regionkey = {region}
)
SELECT c.c_custkey, CASE WHEN vp IS NULL THEN 0 ELSE 1 END AS in_region
FROM {customer} c
LEFT JOIN {nation} n ON c.c_nationkey = n.n_nationkey
LEFT JOIN vprefixes ON substring(n.n_name, 1, {prefix_len}) = vp
"""

AVG_BY_DIMENSION_SQL = """
SELECT o_orderpriority,
       CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / count(o_totalprice) / 100.0D AS avg_price
FROM {orders} o
JOIN {customer} c ON o.o_custkey = c.c_custkey
JOIN {nation} n ON c.c_nationkey = n.n_nationkey
WHERE n.n_name = :nation_name
GROUP BY o_orderpriority
"""

SEMI_JOIN_LIKE_SQL = """
WITH hits AS (SELECT p_partkey FROM {part} WHERE p_name ILIKE :pattern)
SELECT f.in_region,
       CAST(sum(CAST(round(l.l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / count(l.l_extendedprice) / 100.0D
         AS avg_price
FROM {lineitem} l
JOIN {orders} o ON l.l_orderkey = o.o_orderkey
JOIN {flags} f ON o.o_custkey = f.c_custkey
WHERE l.l_partkey IN (SELECT p_partkey FROM hits)
GROUP BY f.in_region
"""

DAILY_MEAN_SQL = """
SELECT to_date(o_orderdate) AS order_date,
       CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / count(o_totalprice) / 100.0D AS avg_price
FROM {orders}
WHERE month(to_date(o_orderdate)) = {month} AND dayofmonth(to_date(o_orderdate)) <= {max_day}
GROUP BY to_date(o_orderdate)
"""


def region_flag_sql(spark: SparkSession, customer: DataFrame, nation: DataFrame, region: int,
                    prefix_len: int = 8) -> DataFrame:
    return spark.sql(REGION_FLAG_SQL, customer=customer, nation=nation, region=int(region),
                     prefix_len=int(prefix_len))


def flags_view(spark: SparkSession, customer: DataFrame, nation: DataFrame, region: int,
               prefix_len: int = 8, name: str = "region_flags") -> str:
    """Named view over the flag query (the original's persistent view)."""
    region_flag_sql(spark, customer, nation, region, prefix_len).createOrReplaceTempView(name)
    return name


def avg_by_dimension_sql(spark: SparkSession, orders: DataFrame, customer: DataFrame,
                         nation: DataFrame, nation_name: str) -> DataFrame:
    return spark.sql(AVG_BY_DIMENSION_SQL, args={"nation_name": nation_name},
                     orders=orders, customer=customer, nation=nation)


def semi_join_like_sql(spark: SparkSession, part: DataFrame, lineitem: DataFrame,
                       orders: DataFrame, flags: DataFrame, pattern: str) -> DataFrame:
    return spark.sql(SEMI_JOIN_LIKE_SQL, args={"pattern": pattern},
                     part=part, lineitem=lineitem, orders=orders, flags=flags)


def daily_mean_window_sql(spark: SparkSession, orders: DataFrame, month: int,
                          max_day: int) -> DataFrame:
    return spark.sql(DAILY_MEAN_SQL, orders=orders, month=int(month), max_day=int(max_day))
