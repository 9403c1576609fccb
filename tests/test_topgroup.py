"""Largest value per group: one winner, value, ties, list; hour from path."""
from pyspark.sql import functions as F

from tessera.functions.text import path_to_hour
from tessera.operators.topgroup import (max_by_group_list, max_by_group_one, max_by_group_ties,
                                        max_by_group_value, page_filter)
from tessera.sources.readers import read_pagecounts
from tessera.sources.schemas import PAGECOUNT_FILE_SCHEMA, PAGECOUNT_ROW_SCHEMA

from conftest import rows

PAGES = [
    "20160801-00 en Apple 5 1", "20160801-00 en Banana 5 1",          # tie
    "20160801-00 en Main_Page 99 1", "20160801-00 en Special:Search 50 1",
    "20160801-00 fr Pomme 77 1",                                      # other language
    "20160801-01 en Zero 0 1", "20160801-01 en Short",                # views 0, short line
    '20160801-02 en "Quoted 3 1',                                     # title starts with a quote
]


def _pages(spark, tmp_path):
    p = tmp_path / "pc.txt"
    p.write_text("\n".join(PAGES) + "\n")
    return page_filter(read_pagecounts(spark, str(p), PAGECOUNT_ROW_SCHEMA))


def test_one_winner_takes_largest_title_on_tie(spark, tmp_path):
    got = rows(max_by_group_one(_pages(spark, tmp_path), "hour", "views", "title"))
    assert got == [("20160801-00", 5, "Banana"), ("20160801-01", 0, "Zero"),
                   ("20160801-02", 3, '"Quoted')]


def test_value_floor_zero(spark, tmp_path):
    got = rows(max_by_group_value(_pages(spark, tmp_path), "hour", "views"))
    assert got == [("20160801-00", 5), ("20160801-01", 0), ("20160801-02", 3)]


def test_ties_kept_and_listed(spark, tmp_path):
    df = _pages(spark, tmp_path)
    ties = rows(max_by_group_ties(df, "hour", "views", ["title"]))
    assert ("20160801-00", "Apple", 5) in ties and ("20160801-00", "Banana", 5) in ties
    lst = dict(rows(max_by_group_list(df, "hour", "views", "title"), "hour", "titles"))
    assert lst["20160801-00"] == "Apple,Banana"


def test_ties_uses_checked_broadcast(spark, tmp_path):
    plan = max_by_group_ties(_pages(spark, tmp_path), "hour", "views", ["title"])._jdf \
        .queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_hour_from_file_name(spark, tmp_path):
    good = tmp_path / "pagecounts-20160801-120000"
    good.write_text("en Apple 5 1\nen Null_Title_Next 1 1\n")
    bad = tmp_path / "other-file"
    bad.write_text("en Pear 7 1\n")
    df = read_pagecounts(spark, str(tmp_path), PAGECOUNT_FILE_SCHEMA, hour_from_file=True)
    got = dict(rows(df, "title", "hour"))
    assert got["Apple"] == "20160801-12" and got["Pear"] is None


def test_path_to_hour_null_when_absent(spark):
    df = spark.createDataFrame([("/x/pagecounts-20160801-05.gz",), ("/x/nothing.gz",)], "p string")
    assert rows(df.select(path_to_hour(F.col("p")).alias("h"))) == [("20160801-05",), (None,)]


def test_null_title_is_dropped(spark, tmp_path):
    p = tmp_path / "pc.txt"
    p.write_text("20160801-00 en\n20160801-00 en Kiwi 3 1\n")
    df = page_filter(read_pagecounts(spark, str(p), PAGECOUNT_ROW_SCHEMA))
    assert rows(df, "title") == [("Kiwi",)]


from hypothesis import HealthCheck, given, settings, strategies as st  # noqa: E402


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["h1", "h2", "h3"]), st.sampled_from(list("ABCDE")),
                          st.integers(0, 4)), min_size=1, max_size=50))
def test_top_per_group_matches_python(spark, data):
    df = spark.createDataFrame(data, "hour string, title string, views long")
    best = {}
    for h, t, v in data:
        best[h] = max(best.get(h, (v, t)), (v, t))
    assert rows(max_by_group_one(df, "hour", "views", "title")) == sorted((h, v, t) for h, (v, t) in best.items())
    mx = {h: v for h, (v, _) in best.items()}
    ties = sorted((h, t, v) for h, t, v in data if v == mx[h])
    assert rows(max_by_group_ties(df, "hour", "views", ["title"])) == ties
