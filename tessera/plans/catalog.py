"""The purchase reports over catalog tables and named views.

Frames are stored as tables of a database of their own, analysed column by
column, and reported on by name, in plain SQL.  With the statistics Spark's
cost-based optimizer orders the joins by their estimated sizes instead of by
the text.  Views are catalog objects over these tables, usable by any session
of the application until the database is dropped.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ..operators.joins import materialize
from ..session import delete_path, scratch_path

COST_BASED = {"spark.sql.cbo.enabled": "true", "spark.sql.cbo.joinReorder.enabled": "true",
              "spark.sql.statistics.histogram.enabled": "true"}


class ReportCatalog:
    """A database of report tables."""

    def __init__(self, spark: SparkSession, name: str, root: str):
        self.spark, self.name, self.root = spark, name, root

    def table(self, name: str, df: DataFrame, analyse: bool = True) -> str:
        """Stores ``df`` as a table; returns its qualified name."""
        full = f"{self.name}.{name}"
        df.write.option("path", f"{self.root}/{name}").saveAsTable(full)
        if analyse:
            self.analyse(name)
        return full

    def analyse(self, name: str) -> None:
        """Row count, and per column: distinct values, nulls, range, histogram."""
        self.spark.sql(f"ANALYZE TABLE {self.name}.{name} COMPUTE STATISTICS FOR ALL COLUMNS")

    def view(self, name: str, query: str) -> str:
        full = f"{self.name}.{name}"
        self.spark.sql(f"CREATE OR REPLACE VIEW {full} AS {self.named(query)}")
        return full

    def named(self, query: str) -> str:
        return query.replace("{db}", self.name)

    def sql(self, query: str, args: dict | None = None) -> DataFrame:
        """``{db}`` in the text stands for the database's name."""
        return self.spark.sql(self.named(query), args=args)

    def report(self, query: str, args: dict | None = None) -> DataFrame:
        """The query's rows, stored: they outlive the catalog."""
        return materialize(self.sql(query, args))


@contextmanager
def report_catalog(spark: SparkSession, cost_based: bool = True) -> Iterator[ReportCatalog]:
    """A fresh database; at the end it is dropped with all its tables, views
    and files, and the optimizer's settings are as before."""
    name, root = f"tessera_{uuid.uuid4().hex[:12]}", scratch_path(spark, "catalog")
    before = {k: spark.conf.get(k, None) for k in COST_BASED}
    spark.sql(f"CREATE DATABASE {name} LOCATION '{root}'")
    try:
        if cost_based:
            for k, v in COST_BASED.items():
                spark.conf.set(k, v)
        yield ReportCatalog(spark, name, root)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
        delete_path(spark, root)


MEAN = "CAST(sum(CAST(round({v} * 100) AS BIGINT)) AS DOUBLE) / count({v}) / 100.0D"

REGION_CUSTOMERS = """
WITH vprefixes (vp) AS (SELECT DISTINCT substring(n_name, 1, {prefix_len}) FROM {{db}}.nation WHERE n_regionkey = {region})
SELECT c_custkey, CASE WHEN vp IS NULL THEN 0 ELSE 1 END AS in_region
FROM {{db}}.customer LEFT JOIN {{db}}.nation ON c_nationkey = n_nationkey
LEFT JOIN vprefixes ON substring(n_name, 1, {prefix_len}) = vprefixes.vp
"""

AVG_BY_PRIORITY = f"""
SELECT o_orderpriority, {MEAN.format(v='o_totalprice')} AS avg_price
FROM {{db}}.orders JOIN {{db}}.customer ON o_custkey = c_custkey JOIN {{db}}.nation ON c_nationkey = n_nationkey
WHERE n_name = :nation_name GROUP BY o_orderpriority
"""

AVG_BY_REGION = f"""
SELECT in_region, {MEAN.format(v='l_extendedprice')} AS avg_price
FROM {{db}}.lineitem JOIN {{db}}.orders ON l_orderkey = o_orderkey JOIN {{db}}.region_customers ON o_custkey = c_custkey
WHERE l_partkey IN (SELECT p_partkey FROM {{db}}.part WHERE p_name ILIKE :pattern)
GROUP BY in_region ORDER BY in_region
"""

DAILY_MEAN = f"""
SELECT CAST(o_orderdate AS DATE) AS order_date, {MEAN.format(v='o_totalprice')} AS avg_price FROM {{db}}.orders
WHERE date_part('day', CAST(o_orderdate AS DATE)) <= :max_day AND date_part('month', CAST(o_orderdate AS DATE)) = :month
GROUP BY order_date ORDER BY order_date ASC
"""


def region_view(catalog: ReportCatalog, region: int, prefix_len: int) -> str:
    return catalog.view("region_customers", REGION_CUSTOMERS.format(region=int(region), prefix_len=int(prefix_len)))
