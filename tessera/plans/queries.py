"""Registered queries: each is ``(spark, sf_dir) -> DataFrame`` over whole tables.

Parameters that pick categories in the derived inputs (the TMAX event
type, the region whose prefixes count as "local", the BFS source) are
fixed here and mirrored in ``oracle.py``.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from .. import sinks
from ..functions.colour import colour_table, lab_to_rgb_cols, rgb_to_hsv, rgb_to_lab
from ..functions.numeric import cents
from ..functions.text import path_to_hour
from ..operators import etl, graph, logs, ml, paths, ranges, ratios, reports, sampling, setops, topgroup, upsert
from ..operators.caching import held
from ..operators.joins import materialize
from ..operators.keyed import KeyedTable
from ..operators.partitioning import spread_rows
from ..operators.wordcount import word_count
from ..session import rename_folders, scratch_path
from ..sources import derived
from ..sources.clustered import write_clustered
from ..sources.quarantine import split_lines
from ..sources.readers import read_compressed_lines, read_csv, read_json, read_pagecounts, read_text
from ..sources.schemas import (COMMENT_FULL_SCHEMA, COMMENT_SCHEMA, OBSERVATION_CSV_SCHEMA, PAGECOUNT_FILE_SCHEMA,
                               PAGECOUNT_ROW_SCHEMA, WEATHER_SCHEMA)
from ..sources.tables import load
from . import catalog

# Fixed parameters of the registered queries (mirrored in oracle.py).
PAGE_LANGUAGE, MAIN_PAGE, SPECIAL_PREFIX = "view", "P0", "P1"
SCORE_SPLIT = 50
STATION_PREFIX = "U1"
BFS_SOURCE, BFS_HOPS = 9, 6
BFS_DESTINATION = 42
R2_FLOOR, RMSE_CEILING, ACCURACY_FLOOR = 0.9, 2.5, 0.7
REPORT_NATION = "NATION_3"
FLAG_REGION, PREFIX_LEN = 2, 8
FLAG_SEGMENT = "BUILDING"
PART_PATTERN = "%RING%"
WINDOW_MONTH, WINDOW_MAX_DAY = 8, 5
TOP_K = 10
PASSAGE_SEED, SPLIT_SEED = 42, 40
LONG_DOC_CHARS = 2000
GRID_SIZE, GRID_LUM = 256, 70.0
ROUND = 6
AMENITY = "restaurant"
SHORT_FIT, MANY_TREES = 5, 60


def _r6(c: F.Column) -> F.Column:
    # +0.0 turns a rounded -0.0 into 0.0 so both engines print the same.
    return F.round(c, ROUND) + F.lit(0.0)


# --- text ------------------------------------------------------------------

def _cores(spark) -> int:
    return spark.sparkContext.defaultParallelism


def q_wordcount_whitespace(spark, d):
    return word_count(load(spark, d, "documents"), "text", "whitespace",
                      min_partitions=_cores(spark))


def q_wordcount_delimited(spark, d):
    return word_count(load(spark, d, "documents"), "text", "delimited",
                      min_partitions=_cores(spark))


def q_wordcount_whitespace_empty(spark, d):
    """As the whitespace count, with tokens of punctuation only counted as ''."""
    return word_count(load(spark, d, "documents"), "text", "whitespace", keep_empty=True,
                      min_partitions=_cores(spark))


def q_wordcount_text(spark, d):
    """The whitespace count over text files that Spark writes from ``documents``."""
    path = scratch_path(spark, "text")
    load(spark, d, "documents").select(F.coalesce("text", F.lit("")).alias("value")).write.text(path)
    return word_count(read_text(spark, path), "value", "whitespace")


def q_wordcount_keep_empty(spark, d):
    return word_count(load(spark, d, "documents"), "text", "delimited", keep_empty=True,
                      min_partitions=_cores(spark))


# --- largest per group -----------------------------------------------------

def _pages(spark, d):
    return topgroup.page_filter(derived.pagecounts(spark, d), PAGE_LANGUAGE, MAIN_PAGE, SPECIAL_PREFIX)


def q_max_by_group_one(spark, d):
    return topgroup.max_by_group_one(_pages(spark, d), "hour", "views", "title")


def q_max_by_group_value(spark, d):
    return topgroup.max_by_group_value(_pages(spark, d), "hour", "views", floor=0)


def q_max_by_group_ties(spark, d):
    return topgroup.max_by_group_ties(_pages(spark, d), "hour", "views", ["title"])


def q_max_by_group_list(spark, d):
    return topgroup.max_by_group_list(_pages(spark, d), "hour", "views", "title")


def q_top_pages_text(spark, d):
    """Every page tied for its hour's maximum, from space-delimited page-count
    lines that Spark writes from ``events``, sorted by hour and title."""
    path = scratch_path(spark, "pagecounts")
    derived.pagecounts(spark, d).select(F.concat_ws(" ", "hour", "language", "title", "views", F.lit("0"))
                                        .alias("value")).write.text(path)
    pages = topgroup.page_filter(read_pagecounts(spark, path, PAGECOUNT_ROW_SCHEMA),
                                 PAGE_LANGUAGE, MAIN_PAGE, SPECIAL_PREFIX)
    return topgroup.max_by_group_ties(pages, "hour", "views", ["title"]).orderBy("hour", "title")


def q_path_to_hour(spark, d):
    p = derived.pagecount_paths(spark, d)
    return p.select("event_id", path_to_hour(F.col("path")).alias("hour"))


# --- means and relative scores ---------------------------------------------

def _scored(spark, d):
    return load(spark, d, "events").select("event_id", F.col("user_id").alias("author"),
                                           "event_type", cents("value").alias("cents"))


def q_mean_by_key(spark, d):
    return ratios.mean_by_key(_scored(spark, d), "event_type", "cents", "avg_value", scale=100)


def q_mean_by_key_json(spark, d):
    """The same mean over JSON lines that Spark writes from ``events``."""
    path = scratch_path(spark, "comments")
    _scored(spark, d).select(F.col("event_type").alias("subreddit"), F.col("cents").alias("score"),
                             F.col("author").cast("string").alias("author")).write.json(path)
    means = ratios.mean_by_key(read_json(spark, path, COMMENT_SCHEMA), "subreddit", "score", "avg_value", scale=100)
    return means.withColumnRenamed("subreddit", "event_type")


def q_relative_score_join(spark, d):
    return ratios.relative_score(_scored(spark, d), "event_type", "cents",
                                 ["event_id", "author"], strategy="join", descending=True)


def q_relative_score_broadcast(spark, d):
    return ratios.relative_score(_scored(spark, d), "event_type", "cents",
                                 ["event_id", "author"], strategy="broadcast", descending=True)


# --- ETL -------------------------------------------------------------------

def _comments(spark, d):
    return load(spark, d, "events").select(F.col("event_type").alias("subreddit"),
                                           F.col("value").alias("score"),
                                           F.col("user_id").alias("author"))


def q_split_positive(spark, d):
    return etl.comment_split(_comments(spark, d), threshold=SCORE_SPLIT)[0]


def q_split_non_positive(spark, d):
    return etl.comment_split(_comments(spark, d), threshold=SCORE_SPLIT)[1]


def q_etl_filter_project(spark, d):
    return etl.weather_etl(derived.observations(spark, d), STATION_PREFIX, "TMAX")


def q_etl_pushdown(spark, d):
    """Same ETL on the CSV form of the observations: the station prefix,
    observation and null tests reach the CSV scan as pushed filters."""
    path = scratch_path(spark, "observations-csv")
    derived.observations(spark, d).write.csv(path)
    obs = read_csv(spark, path, OBSERVATION_CSV_SCHEMA)
    return etl.weather_etl(obs, STATION_PREFIX, "TMAX")


def q_range_leader_df(spark, d):
    return ranges.range_leader(derived.observations(spark, d))


def q_range_leader_sql(spark, d):
    return ranges.range_leader_sql(spark, derived.observations(spark, d))


# --- logs ------------------------------------------------------------------

def _logs(spark, d):
    return logs.parse_log_lines(derived.loglines(spark, d), "line", seq_col="line_no",
                                min_partitions=_cores(spark))


def q_log_parse(spark, d):
    return _logs(spark, d)


def q_log_host_totals(spark, d):
    return logs.host_totals(_logs(spark, d))


def q_log_correlation(spark, d):
    return logs.log_correlation(logs.host_totals(_logs(spark, d)))


def q_total_sum(spark, d):
    return logs.total_bytes(_logs(spark, d))


def q_upsert_latest(spark, d):
    return upsert.latest_per_key(load(spark, d, "events"), ["user_id", "event_type"],
                                 ["ts", "event_id"])


# --- graph -----------------------------------------------------------------

def q_graph_edges(spark, d):
    return graph.edges_from_adjacency(derived.adjacency_lines(derived.edges(spark, d)))


def _bfs(spark, d):
    return graph.bfs(derived.edges(spark, d), BFS_SOURCE, BFS_HOPS)


def q_bfs_distances(spark, d):
    visited, _ = _bfs(spark, d)
    return visited.select("node", "distance", "parent")


def q_bfs_iterations(spark, d):
    from pyspark.sql import Window
    visited, _ = _bfs(spark, d)
    per_hop = visited.groupBy(F.col("distance").alias("hop")).agg(F.count(F.lit(1)).alias("added"))
    # at most max_hops + 1 rows, so a single ordered window is fine here
    w = Window.orderBy("hop").rowsBetween(Window.unboundedPreceding, 0)
    return per_hop.select("hop", F.sum("added").over(w).cast("bigint").alias("known"))


def q_shortest_path(spark, d):
    """Path to the farthest node reached (the largest id of equals)."""
    visited, _ = _bfs(spark, d)
    far = visited.agg(F.max(F.struct("distance", "node")).alias("far")).first()["far"]
    return graph.path_to(visited, far["node"])


def q_path_to_destination(spark, d):
    """Path to a given node; the search stops at the hop that reaches it."""
    return graph.shortest_path(derived.edges(spark, d), BFS_SOURCE, BFS_DESTINATION, BFS_HOPS)


# --- set operations, top-k -------------------------------------------------

def q_except_distinct(spark, d):
    """(user, day) pairs with a purchase but no view that day."""
    ev = load(spark, d, "events")
    day = F.col("ts").cast("date").alias("day")
    return setops.except_distinct(ev.where(F.col("event_type") == "purchase").select("user_id", day),
                                  ev.where(F.col("event_type") == "view").select("user_id", day))


def q_union_all(spark, d):
    ev = load(spark, d, "events")
    return setops.union_all(ev.where(F.col("event_type") == "click").select("event_id", "user_id"),
                            ev.where(F.col("event_type") == "view").select("user_id", "event_id"))


def q_distinct_keys(spark, d):
    return setops.distinct_keys(load(spark, d, "events"), ["user_id", "event_type"])


def q_top_k_rows(spark, d):
    return setops.top_k_rows(load(spark, d, "orders"), TOP_K,
                             [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()],
                             ["o_orderkey", "o_custkey", "o_totalprice"])


# --- purchase reports ------------------------------------------------------

def _flags(spark, d):
    return reports.region_flag(load(spark, d, "customer"), load(spark, d, "nation"),
                               FLAG_REGION, PREFIX_LEN)


def q_avg_by_dimension(spark, d):
    return reports.avg_by_dimension(load(spark, d, "orders"), load(spark, d, "customer"),
                                    load(spark, d, "nation"), REPORT_NATION)


def q_region_flag(spark, d):
    return _flags(spark, d)


def q_spend_by_flags(spark, d):
    return reports.spend_by_flags(load(spark, d, "orders"), load(spark, d, "customer"),
                                  _flags(spark, d), FLAG_SEGMENT)


def q_semi_join_like(spark, d):
    return reports.semi_join_like(load(spark, d, "part"), load(spark, d, "lineitem"),
                                  load(spark, d, "orders"), _flags(spark, d), PART_PATTERN)


def q_daily_mean_window(spark, d):
    return reports.daily_mean_window(load(spark, d, "orders"), WINDOW_MONTH, WINDOW_MAX_DAY)


def q_region_flag_sql(spark, d):
    from .sql_reports import region_flag_sql
    return region_flag_sql(spark, load(spark, d, "customer"), load(spark, d, "nation"),
                           FLAG_REGION, PREFIX_LEN)


def q_avg_by_dimension_sql(spark, d):
    from .sql_reports import avg_by_dimension_sql
    return avg_by_dimension_sql(spark, load(spark, d, "orders"), load(spark, d, "customer"),
                                load(spark, d, "nation"), REPORT_NATION)


def q_semi_join_like_sql(spark, d):
    from .sql_reports import region_flag_sql, semi_join_like_sql
    flags = region_flag_sql(spark, load(spark, d, "customer"), load(spark, d, "nation"),
                            FLAG_REGION, PREFIX_LEN)
    return semi_join_like_sql(spark, load(spark, d, "part"), load(spark, d, "lineitem"),
                              load(spark, d, "orders"), flags, PART_PATTERN)


def q_daily_mean_window_sql(spark, d):
    from .sql_reports import daily_mean_window_sql
    return daily_mean_window_sql(spark, load(spark, d, "orders"), WINDOW_MONTH, WINDOW_MAX_DAY)


# --- features, colours -----------------------------------------------------

def q_previous_day_features(spark, d):
    return ml.previous_day_features(derived.tmax_daily(spark, d))


def q_rgb_to_lab(spark, d):
    lab = rgb_to_lab(derived.colours(spark, d))
    return lab.select("p_partkey", "R", "G", "B", "word",
                      *[_r6(F.col(c)).alias(c) for c in ("labL", "labA", "labB")])


def q_rgb_to_hsv(spark, d):
    hsv = rgb_to_hsv(derived.colours(spark, d))
    return hsv.select("p_partkey", "R", "G", "B", "word",
                      *[_r6(F.col(c)).alias(c) for c in ("H", "S", "V")])


def q_colour_lookup(spark, d):
    words = load(spark, d, "part").select(
        "p_partkey", F.split(F.col("p_name"), " ").getItem(0).alias("word"))
    # 11 rows
    return words.join(F.broadcast(colour_table(spark)), "word").select("p_partkey", "word", "R", "G", "B")


def q_colour_grid(spark, d):
    """LAB plane at L=70: grid cell (i, j) of a 256x256 lattice over a, b in
    [-100, 100], one cell per part (i = key % 256, j = key / 256 % 256)."""
    k = F.col("p_partkey")
    step = 200.0 / (GRID_SIZE - 1)
    g = load(spark, d, "part").select(
        "p_partkey",
        (F.lit(-100.0) + (k % GRID_SIZE).cast("double") * F.lit(step)).alias("labA"),
        (F.lit(-100.0) + (F.floor(k / GRID_SIZE) % GRID_SIZE).cast("double") * F.lit(step))
        .alias("labB"))
    rgb = lab_to_rgb_cols(F.lit(GRID_LUM), F.col("labA"), F.col("labB"))
    return g.select("p_partkey", _r6(F.col("labA")).alias("labA"), _r6(F.col("labB")).alias("labB"),
                    *[_r6(c * F.lit(255.0)).alias(n) for c, n in zip(rgb, "RGB")])


def q_json_roundtrip(spark, d):
    ev = load(spark, d, "events")
    k = F.from_json("props", "k bigint").getField("k")
    return ev.select("event_id", k.alias("k")) \
             .select("event_id", "k", F.to_json(F.struct("k")).alias("props_json"))


# --- sampling, regression --------------------------------------------------

def q_first_passage_mean(spark, d):
    return sampling.first_passage_mean(load(spark, d, "events"), "event_id", PASSAGE_SEED,
                                       min_partitions=_cores(spark))


def q_regression_batch(spark, d):
    from ..functions.stats import ols
    ev = load(spark, d, "events").select(F.col("event_id").alias("x"), cents("value").alias("y"))
    return ols(ev, "x", "y")


def q_stream_regression(spark, d):
    """File stream over "x y" lines that Spark writes from ``events`` (several
    files per micro-batch), run with availableNow until all are read; returns
    the last batch's running (n, slope, intercept)."""
    from ..streaming.regression import run_file_stream
    src = scratch_path(spark, "points")
    derived.xy_lines(spark, d).select("value").write.text(src)
    return run_file_stream(spark, src, scratch_path(spark, "fit"), scratch_path(spark, "ckpt"))


def q_hash_split(spark, d):
    return sampling.hash_split(load(spark, d, "events").select("event_id"), "event_id", SPLIT_SEED)


def q_string_index(spark, d):
    from pyspark.ml.feature import StringIndexer
    p = load(spark, d, "part").select("p_partkey", "p_brand")
    model = StringIndexer(inputCol="p_brand", outputCol="label_index").fit(p)
    return model.transform(p)


def q_regression_metrics(spark, d):
    f = ml.previous_day_features(derived.tmax_daily(spark, d))
    return ml.exact_regression_metrics(f, "tmax", "yesterday_tmax")


def q_accuracy_metric(spark, d):
    docs = load(spark, d, "documents").select("doc_id", "n_chars")
    lab = load(spark, d, "labels").select("doc_id", "quality")
    pred = docs.join(lab, "doc_id").select(
        "quality", F.when(F.col("n_chars") >= LONG_DOC_CHARS, 1).otherwise(0).alias("predicted"))
    return ml.exact_accuracy(pred, "quality", "predicted")


def q_gbt_predictions(spark, d):
    """Next-day fit over all features: every row's key, split and label, and
    whether the validation r2 and RMSE keep their fixed bounds."""
    f = ml.previous_day_features(derived.tmax_daily(spark, d))
    f = sampling.hash_split(f.withColumn("_id", F.concat_ws(":", "station", F.col("date").cast("string"))),
                            "_id", SPLIT_SEED)
    model = ml.gbt_pipeline().fit(f.where(F.col("split") == "train"))
    pred = materialize(model.transform(f).select("station", "date", "split", "tmax", "prediction"))
    m = ml.exact_regression_metrics(pred.where("split = 'validation'"), "tmax", "prediction").first()
    return pred.select("station", "date", "split", "tmax", F.lit(m["r2"] > R2_FLOOR).alias("r2_ok"),
                       F.lit(m["rmse"] < RMSE_CEILING).alias("rmse_ok"),
                       F.col("prediction").isNotNull().alias("predicted"))


def _colour_model(spark, d):
    c = sampling.hash_split(ml.colour_features(derived.colours(spark, d), space="lab"), "p_partkey", SPLIT_SEED)
    c = materialize(spread_rows(c))
    n_labels = c.select(F.count_distinct("word")).first()[0]
    return c, ml.mlp_pipeline(n_labels).fit(c.where(F.col("split") == "train"))


def q_mlp_predictions(spark, d):
    """Colour-word fit: every sample's key, split and word, and whether the
    validation accuracy keeps its fixed bound."""
    c, model = _colour_model(spark, d)
    pred = materialize(ml.with_predicted_label(model, model.transform(c))
                       .select("p_partkey", "split", "word", "predicted_word"))
    m = ml.exact_accuracy(pred.where("split = 'validation'"), "word", "predicted_word").first()
    return pred.select("p_partkey", "split", "word", F.lit(m["accuracy"] > ACCURACY_FLOOR).alias("accuracy_ok"),
                       F.col("predicted_word").isNotNull().alias("predicted"))


def q_prediction_grid(spark, d):
    """The 256x256 LAB plane at L=70 through the colour-word model: each cell's
    colour, and whether its word was found in the colour table."""
    _, model = _colour_model(spark, d)
    grid = ml.prediction_grid(model, ml.lab_grid(spark, GRID_LUM, GRID_SIZE))
    return grid.select(*[_r6(F.col(c)).alias(c) for c in ("labA", "labB", "R", "G", "B")],
                       F.col("word_R").isNotNull().alias("word_found"))


# --- keyed table -------------------------------------------------------------

KEYS, NEWEST = ["user_id", "event_type"], ["ts", "event_id"]
LOAD_SPLIT = "2024-01-16"


def _keyed_table(spark, events):
    return KeyedTable.create(spark, scratch_path(spark, "keyed"), events.schema, KEYS, NEWEST)


def q_keyed_upsert(spark, d):
    """Two loads into a keyed table, the later half of ``events`` first, and
    the earlier one again: each key's newest row."""
    events = load(spark, d, "events")
    table = _keyed_table(spark, events)
    later = F.col("ts") >= F.lit(LOAD_SPLIT).cast("timestamp_ntz")
    for part in (events.where(later), events.where(~later), events.where(~later)):
        table.upsert(part)
    return table.read()


def q_keyed_lookup(spark, d):
    """The newest purchase of every user who met an error, by key look-up."""
    events = load(spark, d, "events")
    table = _keyed_table(spark, events)
    table.overwrite(events, confirm_truncate=True)
    keys = events.where("event_type = 'error'").select("user_id", F.lit("purchase").alias("event_type"))
    return table.lookup(keys)


def q_stream_upsert(spark, d):
    """The same table filled by a stream over files, one merge per batch."""
    from ..streaming.upserts import upsert_file_stream
    events = load(spark, d, "events")
    files = scratch_path(spark, "event-files")
    events.repartition(4).write.parquet(files)
    table = _keyed_table(spark, events)
    return upsert_file_stream(spark, files, events.schema, table.root, "events", scratch_path(spark, "ckpt"), 2)


# --- layouts, malformed input, nested columns, catalog ------------------------

def q_etl_clustered(spark, d):
    """The station ETL over a stored copy clustered by station and date."""
    path = scratch_path(spark, "observations")
    write_clustered(derived.observations(spark, d), path, ["observation", "station", "date"], bloom=("station",))
    return etl.weather_etl(spark.read.parquet(path), STATION_PREFIX, "TMAX")


def _lines(spark, d, kind):
    path = scratch_path(spark, "lines")
    if kind == "json":
        derived.comment_lines(spark, d).write.text(path)
        return split_lines(spark, path, "json", COMMENT_SCHEMA, ("subreddit", "score"))
    derived.observation_lines(spark, d).write.text(path)
    return split_lines(spark, path, "csv", WEATHER_SCHEMA, ("station", "date"))


def q_json_good(spark, d):
    return _lines(spark, d, "json")[0]


def q_json_quarantine(spark, d):
    return _lines(spark, d, "json")[1].select("line", "reason")


def q_csv_good(spark, d):
    return _lines(spark, d, "csv")[0].select("station", "date", "observation", "value", "sflag")


def q_csv_quarantine(spark, d):
    return _lines(spark, d, "csv")[1].select("line", "reason")


def q_semi_join_nested(spark, d):
    path = scratch_path(spark, "amenities")
    derived.amenities(spark, d).write.parquet(path)
    return reports.semi_join_nested(spark.read.parquet(path), load(spark, d, "lineitem"), load(spark, d, "orders"),
                                    _flags(spark, d), AMENITY, PART_PATTERN)


def _catalog_report(spark, d, tables, query, args, view=False):
    with catalog.report_catalog(spark) as c:
        for t in tables:
            c.table(t, load(spark, d, t))
        if view:
            catalog.region_view(c, FLAG_REGION, PREFIX_LEN)
        return c.report(query, args)


def q_catalog_avg_by_dimension(spark, d):
    return _catalog_report(spark, d, ("orders", "customer", "nation"), catalog.AVG_BY_PRIORITY,
                           {"nation_name": REPORT_NATION})


def q_catalog_semi_join(spark, d):
    """Through a named view over catalog tables."""
    return _catalog_report(spark, d, ("lineitem", "orders", "customer", "nation", "part"), catalog.AVG_BY_REGION,
                           {"pattern": PART_PATTERN}, view=True)


def q_catalog_daily_mean(spark, d):
    return _catalog_report(spark, d, ("orders",), catalog.DAILY_MEAN, {"month": WINDOW_MONTH, "max_day": WINDOW_MAX_DAY})


# --- SQL stages, ablation, early stop ----------------------------------------

def q_lab_sql_stage(spark, d):
    """LAB by a SQL stage of a pipeline that was saved and loaded."""
    path = scratch_path(spark, "lab-model")
    c = derived.colours(spark, d)
    Pipeline(stages=[ml.lab_stage(("p_partkey", "R", "G", "B", "word"))]).fit(c).write().save(path)
    lab = PipelineModel.load(path).transform(c)
    return lab.select("p_partkey", "R", "G", "B", "word", *[_r6(F.col(c)).alias(c) for c in ("labL", "labA", "labB")])


def _split_features(spark, d):
    f = ml.previous_day_features(derived.tmax_daily(spark, d))
    return sampling.hash_split(f.withColumn("_id", F.concat_ws(":", "station", F.col("date").cast("string"))),
                               "_id", SPLIT_SEED)


def q_sql_stage_predictions(spark, d):
    """A fit whose features are a SQL stage: saved, loaded and applied to the
    plain daily rows; ``same``: the loaded model predicts as the fitted one."""
    daily, path = materialize(derived.tmax_daily(spark, d)), scratch_path(spark, "model")
    model, features = ml.fit_stored(ml.gbt_pipeline(max_iter=SHORT_FIT, with_sql_stage=True), daily)
    model.write().save(path)
    keys = ["station", "date", "day_of_year", "tmax", "yesterday_tmax"]
    ours = PipelineModel(model.stages[1:]).transform(features).select("station", "date", F.col("prediction").alias("_fitted"))
    return PipelineModel.load(path).transform(daily).join(ours, ["station", "date"]) \
        .select(*keys, (F.col("prediction") == F.col("_fitted")).alias("same"))


def q_next_day_predictions(spark, d):
    """Every station's day after its last one, by a saved model."""
    daily, path = materialize(derived.tmax_daily(spark, d)), scratch_path(spark, "model")
    ml.gbt_pipeline(max_iter=SHORT_FIT).fit(materialize(ml.previous_day_features(daily))).write().save(path)
    nxt = ml.predict_next_day(PipelineModel.load(path), daily)
    return nxt.select("station", "date", "yesterday_tmax", (F.abs(F.col("prediction") - F.col("yesterday_tmax")) < 25).alias("near"))


def q_feature_ablation(spark, d):
    """All features, without yesterday's value, and that value alone: which
    sets keep the bounds, and the most important feature of each."""
    everything = ml.TEMPERATURE_FEATURES
    sets = {"all": everything, "without_yesterday": tuple(c for c in everything if c != "yesterday_tmax"),
            "yesterday_only": ("yesterday_tmax",)}
    got = ml.ablation(_split_features(spark, d), sets, max_iter=SHORT_FIT)
    first = F.array_max(F.transform(F.map_entries("importances"), lambda e: F.struct(e["value"], e["key"])))["key"]
    return got.select("name", "n_features", (F.col("r2") > R2_FLOOR).alias("r2_ok"), (F.col("rmse") < RMSE_CEILING).alias("rmse_ok"),
                      first.alias("first_feature"))


def q_gbt_early_stop(spark, d):
    """Boosting that ends when the held-out rows stop improving."""
    f = _split_features(spark, d).withColumn("held", F.col("split") == "validation")
    model = ml.gbt_pipeline(max_iter=MANY_TREES, validation="held").fit(f)
    m = ml.exact_regression_metrics(model.transform(f.where("held")), "tmax", "prediction")
    return m.select("n", F.lit(ml.n_trees(model) < MANY_TREES).alias("stopped_early"),
                    (F.col("r2") > R2_FLOOR).alias("r2_ok"), (F.col("rmse") < RMSE_CEILING).alias("rmse_ok"))


def q_path_both_ways(spark, d):
    """The path of ``path_to_destination``, searched from both ends."""
    return paths.path_between(derived.edges(spark, d), BFS_SOURCE, BFS_DESTINATION, BFS_HOPS)[0]


# --- written and read back ----------------------------------------------------

def q_log_totals_gzip(spark, d):
    """Per-host totals of a folder of gzip logs."""
    path = scratch_path(spark, "gzip-logs")
    derived.loglines(spark, d).select(F.col("line").alias("value")).repartition(6).write.option("compression", "gzip").text(path)
    return logs.host_totals(logs.parse_log_lines(read_compressed_lines(spark, path), with_id=False))


def q_split_files(spark, d):
    """The comment split written to its two folders from one cached frame."""
    path, fields = scratch_path(spark, "split"), "subreddit string, score double, author bigint"
    with held(_comments(spark, d)) as comments:
        sinks.write_split(*etl.comment_split(comments, threshold=SCORE_SPLIT), path)
    return spark.read.schema(fields).json([f"{path}/positive", f"{path}/negative"]) \
        .select("subreddit", "score", "author", F.regexp_extract("_metadata.file_path", "/(positive|negative)/", 1).alias("side"))


def q_wordcount_lines(spark, d):
    """'word count' lines, sorted by word."""
    path = scratch_path(spark, "counts")
    sinks.write_count_lines(q_wordcount_delimited(spark, d), path)
    return read_text(spark, path)


def q_max_tab_separated(spark, d):
    path = scratch_path(spark, "maxima")
    sinks.write_tab_separated(q_max_by_group_one(spark, d).select("hour", "views", "title"), path)
    return read_text(spark, path)


def q_max_json_arrays(spark, d):
    path = scratch_path(spark, "maxima")
    sinks.write_json_arrays(q_max_by_group_value(spark, d).select("hour", "views"), path)
    return read_text(spark, path)


def q_etl_json_gzip(spark, d):
    path = scratch_path(spark, "tmax")
    sinks.write_json(q_etl_filter_project(spark, d), path, gzip=True)
    return spark.read.schema("station string, date date, tmax double").json(path)


def q_top_pages_json(spark, d):
    """Pages tied for their hour's maximum; the hour is taken from the names of
    the folders the page counts lie in."""
    counts, out = scratch_path(spark, "dump"), scratch_path(spark, "top")
    derived.pagecounts(spark, d).select("hour", F.concat_ws(" ", "language", "title", "views", F.lit("0")).alias("value")) \
        .repartition("hour").write.partitionBy("hour").text(counts)
    rename_folders(spark, counts, "hour=", "pagecounts-")
    pages = read_pagecounts(spark, f"{counts}/pagecounts-*", PAGECOUNT_FILE_SCHEMA, hour_from_file=True)
    pages = topgroup.page_filter(pages, PAGE_LANGUAGE, MAIN_PAGE, SPECIAL_PREFIX)
    sinks.write_json(topgroup.max_by_group_ties(pages, "hour", "views", ["title"]).orderBy("hour", "title"), out)
    return spark.read.schema("hour string, title string, views bigint").json(out)


def q_range_leader_csv(spark, d):
    path = scratch_path(spark, "leaders")
    leaders = q_range_leader_df(spark, d).select("date", "station", "range", "pairs")
    sinks.write_csv(leaders, path)
    return spark.read.schema(leaders.schema).csv(path)


def q_bfs_snapshots(spark, d):
    """Known nodes after every hop, from the CSV snapshots of a search."""
    path = scratch_path(spark, "snapshots")
    graph.bfs(derived.edges(spark, d), BFS_SOURCE, BFS_HOPS, snapshot_dir=path)
    hop = F.regexp_extract("_metadata.file_path", r"/iter-(\d+)/", 1).cast("int")
    return spark.read.schema("node bigint, parent bigint, distance int").csv(f"{path}/iter-*") \
        .select(hop.alias("hop"), "node", "parent", "distance")


def q_path_lines(spark, d):
    path = scratch_path(spark, "path")
    sinks.write_path(q_path_both_ways(spark, d), path)
    return read_text(spark, path)


def q_mean_by_key_full(spark, d):
    """The mean per key over comments with all 21 declared fields (and one more)."""
    path = scratch_path(spark, "full-comments")
    events = _scored(spark, d).select(F.col("event_type").alias("subreddit"), F.col("cents").alias("score"),
                                      F.col("event_id").cast("string").alias("id"))
    rest = [F.lit(None).cast(f.dataType).alias(f.name) for f in COMMENT_FULL_SCHEMA if f.name not in events.columns]
    events.select("*", *rest, F.lit("x").alias("further")).write.option("ignoreNullFields", "false").json(path)
    means = ratios.mean_by_key(read_json(spark, path, COMMENT_FULL_SCHEMA), "subreddit", "score", "avg_value", scale=100)
    return means.withColumnRenamed("subreddit", "event_type")


QUERIES = {name[2:]: fn for name, fn in list(globals().items())
           if name.startswith("q_") and callable(fn)}
