"""Reports over catalog tables: statistics, join order, views, clean-up."""
import pytest

from tessera.plans import catalog
from tessera.session import local_path

from conftest import rows


def _tables(c, spark):
    """A large table, one that joins it one to many, and a tiny filter."""
    c.table("big", spark.range(20000).selectExpr("id % 1000 AS a", "id AS v"))
    c.table("mid", spark.range(3000).selectExpr("id % 1000 AS a", "id % 50 AS b"))
    c.table("tiny", spark.range(2).selectExpr("id AS b", "concat('n', id) AS name"))


QUERY = "SELECT count(*) AS n, sum(v) AS s FROM {db}.big JOIN {db}.mid ON big.a = mid.a JOIN {db}.tiny ON mid.b = tiny.b WHERE name = 'n1'"


def _first_join(df):
    """Tables below the deepest join of the optimized plan."""
    plan = df._jdf.queryExecution().optimizedPlan().toString().split("\n")
    depth = [len(x) - len(x.lstrip(" :+-")) for x in plan]
    at = max((d, i) for i, (d, x) in enumerate(zip(depth, plan)) if x.lstrip(" :+-").startswith("Join"))[1]
    end = next((i for i in range(at + 1, len(plan)) if depth[i] <= depth[at]), len(plan))
    return {t for t in ("big", "mid", "tiny") for x in plan[at:end] if f".{t}" in x}


def test_statistics_change_the_join_order(spark):
    with catalog.report_catalog(spark, cost_based=False) as c:
        _tables(c, spark)
        by_text = c.sql(QUERY)
        assert _first_join(by_text) == {"big", "mid"}
        want = rows(by_text)
    with catalog.report_catalog(spark) as c:
        _tables(c, spark)
        by_cost = c.sql(QUERY)
        assert _first_join(by_cost) == {"mid", "tiny"}
        assert rows(by_cost) == want


def test_column_statistics(spark):
    with catalog.report_catalog(spark) as c:
        c.table("t", spark.sql("SELECT * FROM VALUES (1, 'a'), (2, 'b'), (2, null) AS t(k, s)"))
        facts = {r.info_name: r.info_value for r in spark.sql(f"DESCRIBE EXTENDED {c.name}.t k").collect()}
        assert (facts["min"], facts["max"], facts["num_nulls"], facts["distinct_count"]) == ("1", "2", "0", "2")
        assert "3 rows" in next(r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {c.name}.t").collect() if r.col_name == "Statistics")


def test_views_are_shared_and_everything_is_dropped(spark, tmp_path):
    settings = {k: spark.conf.get(k, None) for k in catalog.COST_BASED}
    with catalog.report_catalog(spark) as c:
        c.table("nation", spark.sql("SELECT * FROM VALUES (1, 'AAA1', 0), (2, 'BBB2', 1), (3, 'AAA3', 1) AS t(n_nationkey, n_name, n_regionkey)"))
        c.table("customer", spark.sql("SELECT * FROM VALUES (10, 1), (11, 2), (12, 3), (13, null) AS t(c_custkey, c_nationkey)"))
        view = catalog.region_view(c, 0, 3)
        again = spark.newSession().sql(f"SELECT * FROM {view}")
        assert rows(again) == [(10, 1), (11, 0), (12, 1), (13, 0)]
        assert spark.catalog.tableExists(view)
        kept = c.report("SELECT in_region, count(*) AS n FROM {db}.region_customers GROUP BY in_region")
        name, root = c.name, local_path(c.root)
    assert rows(kept) == [(0, 2), (1, 2)]                        # outlives the catalog
    assert name not in {d.name for d in spark.catalog.listDatabases()}
    import os
    assert not os.path.exists(root)
    assert {k: spark.conf.get(k, None) for k in catalog.COST_BASED} == settings


def test_dropped_after_an_error(spark):
    with pytest.raises(KeyError):
        with catalog.report_catalog(spark) as c:
            c.table("t", spark.range(3).toDF("k"))
            raise KeyError
    assert c.name not in {d.name for d in spark.catalog.listDatabases()}
