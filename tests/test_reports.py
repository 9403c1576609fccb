"""Purchase-style reports on hand-made tables (fixture X10-X14 cases)."""
import statistics

import pytest

from tessera.operators.reports import (avg_by_dimension, daily_mean_window, region_flag,
                                       semi_join_like, spend_by_flags)

from conftest import rows


def _tables(spark):
    nation = spark.createDataFrame(
        [(0, "VANCOUVER_A", 1), (1, "VANCOUVER_B", 1), (2, "VANCOUVER_C", 2), (3, "TORONTO", 3)],
        "n_nationkey int, n_name string, n_regionkey int")
    customer = spark.createDataFrame(
        [(1, 0, "BC"), (2, 2, "BC"), (3, 3, "ON"), (4, None, "BC")],   # 4: null "postal code"
        "c_custkey long, c_nationkey int, c_mktsegment string")
    orders = spark.createDataFrame(
        [(10, 1, 10.0, "2021-08-01"), (11, 1, 20.0, "2021-08-05"), (12, 2, 30.0, "2021-08-06"),
         (13, 3, 40.0, "2021-07-02"), (14, 4, 50.0, "2020-08-02"), (15, 2, 5.0, "2021-08-01")],
        "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate string")
    return nation, customer, orders


def test_region_flag_distinct_prefixes_and_null(spark):
    nation, customer, _ = _tables(spark)
    # region 1 prefixes: VANCOUVER (twice) -> DISTINCT keeps one row per customer
    got = rows(region_flag(customer, nation, region=1, prefix_len=9))
    assert got == [(1, 1), (2, 1), (3, 0), (4, 0)]


def test_avg_by_dimension(spark):
    nation, customer, orders = _tables(spark)
    got = rows(avg_by_dimension(orders, customer, nation, "VANCOUVER_A", group="o_custkey"))
    assert got == [(1, 15.0)]


def test_spend_by_flags_mean_and_median(spark):
    nation, customer, orders = _tables(spark)
    flags = region_flag(customer, nation, region=2, prefix_len=11)   # only VANCOUVER_C is local
    got = rows(spend_by_flags(orders, customer, flags, segment="BC"))
    a = [10.0, 20.0, 50.0]   # BC, not local: customers 1 and 4 (odd count)
    b = [30.0, 5.0]          # local: customer 2 (even count -> interpolated median)
    exp = [(False, False, 1, 40.0, 40.0),
           (False, True, 2, statistics.mean(b), statistics.median(b)),
           (True, False, 3, statistics.mean(a), statistics.median(a))]
    assert [g[:3] + g[4:] for g in got] == [e[:3] + e[4:] for e in exp]
    assert [g[3] for g in got] == pytest.approx([e[3] for e in exp], rel=1e-15)


def test_semi_join_like_ignores_duplicate_matches(spark):
    nation, customer, orders = _tables(spark)
    flags = region_flag(customer, nation, region=1, prefix_len=9)
    part = spark.createDataFrame([(1, "sushi place"), (1, "SUSHI bar"), (2, "pizza")],
                                 "p_partkey long, p_name string")          # duplicate key
    li = spark.createDataFrame([(10, 1, 8.0), (12, 1, 4.0), (13, 2, 100.0)],
                               "l_orderkey long, l_partkey long, l_extendedprice double")
    got = rows(semi_join_like(part, li, orders, flags, "%sushi%"))
    assert got == [(1, 6.0)]


def test_daily_mean_window(spark):
    _, _, orders = _tables(spark)
    got = [(str(d), v) for d, v in rows(daily_mean_window(orders, month=8, max_day=5))]
    assert got == [("2020-08-02", 50.0), ("2021-08-01", 7.5), ("2021-08-05", 20.0)]
