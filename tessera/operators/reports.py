"""Purchase-style reports: joins, a region flag view, AVG/MEDIAN by flags.

Written against the TPC-H-like tables: orders play purchases, customer
plays customers, nation names play postal codes.  Dimension tables
(nation, prefix lists) and the fact-to-customer joins are left to AQE (broadcast when the filtered
customer side turns out small, shuffle join with skew splitting otherwise).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import cents
from .joins import materialize
from .quantiles import exact_median, value_counts
from .ratios import exact_mean


def avg_by_dimension(orders: DataFrame, customer: DataFrame, nation: DataFrame,
                     nation_name: str, group: str = "o_orderpriority",
                     value: str = "o_totalprice", out: str = "avg_price") -> DataFrame:
    """AVG(value) by ``group`` over orders of customers of one nation."""
    nat = nation.where(F.col("n_name") == nation_name).select("n_nationkey")
    cust = customer.select("c_custkey", "c_nationkey") \
                   .join(nat, F.col("c_nationkey") == F.col("n_nationkey"), "left_semi")
    o = orders.select("o_custkey", group, value)
    j = o.join(cust, F.col("o_custkey") == F.col("c_custkey"))
    return j.groupBy(group).agg((exact_mean(cents(value)) / 100.0).alias(out))


def region_flag(customer: DataFrame, nation: DataFrame, region: int, prefix_len: int = 8,
                key: str = "c_custkey", out: str = "in_region") -> DataFrame:
    """(custkey, 0/1): 1 when the first ``prefix_len`` characters of the
    customer's "postal code" (nation name) are among the DISTINCT prefixes
    of the nations of ``region``; a LEFT JOIN null becomes 0."""
    prefixes = (nation.where(F.col("n_regionkey") == region)
                      .select(F.substring("n_name", 1, prefix_len).alias("vp")).distinct())
    codes = nation.select("n_nationkey", F.substring("n_name", 1, prefix_len).alias("pc"))
    c = customer.select(key, "c_nationkey").join(codes, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    j = c.join(prefixes, F.col("pc") == F.col("vp"), "left")
    return j.select(key, F.when(F.col("vp").isNull(), 0).otherwise(1).alias(out))


def spend_by_flags(orders: DataFrame, customer: DataFrame, flags: DataFrame,
                   segment: str, value: str = "o_totalprice") -> DataFrame:
    """COUNT / mean / median of order value by two CASE booleans:
    ``segment_outside`` (customer in ``segment`` and not in the region) and
    ``inside`` (in the region).  The median is exact and distributed
    (``quantiles.exact_median``): no group is gathered in one task."""
    cust = customer.select("c_custkey", "c_mktsegment").join(flags, "c_custkey")
    j = orders.select("o_custkey", value).join(cust, F.col("o_custkey") == F.col("c_custkey"))
    keys = ["segment_outside", "inside"]
    flagged = j.select(
        F.when((F.col("c_mktsegment") == segment) & (F.col("in_region") == 0), True)
         .otherwise(False).alias("segment_outside"),
        F.when(F.col("in_region") == 1, True).otherwise(False).alias("inside"),
        cents(value).alias("_cents"))
    # One pass over the joined rows: counts per (flags, amount) -- far fewer
    # rows than orders -- feed the count, the exact mean and the median.
    counts = materialize(value_counts(flagged, keys, "_cents"))
    has = F.col("_cents").isNotNull()
    total = F.sum(F.when(has, F.col("_c")).otherwise(F.lit(0)))
    amount = F.sum(F.col("_cents").cast("decimal(38,0)") * F.col("_c"))
    stats = counts.groupBy(*keys).agg(
        total.alias("n"),
        (F.when(total > 0, amount.cast("double") / total) / 100.0).alias("mean_price"))
    med = exact_median(counts, keys, "_cents", "_median", counted=True)
    return (stats.join(med, keys, "left")
                 .select(*keys, "n", "mean_price", (F.col("_median") / 100.0).alias("median_price"))
                 .orderBy(*keys))


def semi_join_like(part: DataFrame, lineitem: DataFrame, orders: DataFrame, flags: DataFrame,
                   pattern: str, value: str = "l_extendedprice") -> DataFrame:
    """AVG(value) by region flag over lineitems whose part name matches
    ``pattern`` (case-insensitive LIKE), as a LEFT SEMI join (IN list)."""
    hits = part.where(F.col("p_name").ilike(pattern)).select("p_partkey")
    li = lineitem.select("l_orderkey", "l_partkey", value) \
                 .join(hits, F.col("l_partkey") == F.col("p_partkey"), "left_semi")
    o = orders.select("o_orderkey", "o_custkey") \
              .join(flags, F.col("o_custkey") == F.col("c_custkey"))
    j = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    return j.groupBy("in_region").agg((exact_mean(cents(value)) / 100.0).alias("avg_price"))


def semi_join_nested(amenities: DataFrame, lineitem: DataFrame, orders: DataFrame, flags: DataFrame,
                     amenity: str, pattern: str, value: str = "l_extendedprice") -> DataFrame:
    """AVG(value) by region flag over sales at amenities of one sort whose
    ``tags.cuisine`` matches ``pattern``.  Of the nested column only that leaf
    is read, and the tests on it reach the scan; null tags match nothing, an
    amenity that stands twice counts once."""
    cuisine = F.col("tags.cuisine")
    hits = amenities.where((F.col("amenity") == amenity) & cuisine.ilike(pattern)).select("amenid")
    sales = lineitem.select("l_orderkey", "l_partkey", value).join(hits, F.col("l_partkey") == F.col("amenid"), "left_semi")
    buyers = orders.select("o_orderkey", "o_custkey").join(flags, F.col("o_custkey") == F.col("c_custkey"))
    return sales.join(buyers, F.col("l_orderkey") == F.col("o_orderkey")) \
                .groupBy("in_region").agg((exact_mean(cents(value)) / 100.0).alias("avg_price"))


def daily_mean_window(orders: DataFrame, month: int, max_day: int,
                      date_col: str = "o_orderdate", value: str = "o_totalprice") -> DataFrame:
    """AVG(value) per date for days 1..max_day of a month (every year)."""
    d = F.to_date(F.col(date_col))
    return (orders.select(d.alias("order_date"), value)
                  .where((F.month("order_date") == month) & (F.dayofmonth("order_date") <= max_day))
                  .groupBy("order_date")
                  .agg((exact_mean(cents(value)) / 100.0).alias("avg_price")))
