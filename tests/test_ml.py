"""Spark ML pipelines: GBT next-day model, MLP colour words, metrics (fixture X16/X17)."""
import datetime

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tessera.functions.colour import COLOUR_RGB
from tessera.operators import ml
from tessera.operators.sampling import hash_split
from tessera.sources import derived

from conftest import SF001, rows


def test_sql_stage_equals_dataframe_self_join(spark):
    daily = derived.tmax_daily(spark, SF001)
    a = rows(ml.previous_day_features(daily))
    b = rows(ml.previous_day_stage().transform(daily))
    assert a == b and len(a) > 0


def test_previous_day_gap_and_year_change(spark):
    daily = spark.createDataFrame(
        [("S1", datetime.date(2015, 12, 31), 1.0), ("S1", datetime.date(2016, 1, 1), 2.0),
         ("S1", datetime.date(2016, 1, 3), 4.0), ("S2", datetime.date(2016, 1, 1), 9.0)],
        "station string, date date, tmax double")
    got = rows(ml.previous_day_features(daily), "station", "date", "day_of_year", "yesterday_tmax")
    assert got == [("S1", datetime.date(2016, 1, 1), 1, 1.0)]


def test_previous_day_carries_further_columns(spark):
    f = ml.previous_day_features(derived.tmax_daily(spark, SF001))
    assert f.columns == ["station", "date", "day_of_year", "tmax", "yesterday_tmax", "latitude", "longitude", "elevation"]
    assert f.where("latitude IS NULL OR longitude IS NULL OR elevation IS NULL").count() == 0


def test_ablation_yesterday_matters(spark):
    f = ml.previous_day_features(derived.tmax_daily(spark, SF001)).cache()
    full, without = (ml.gbt_pipeline(c, max_iter=3).fit(f) for c in (
        ml.TEMPERATURE_FEATURES, tuple(c for c in ml.TEMPERATURE_FEATURES if c != "yesterday_tmax")))
    assert ml.regression_metrics(full.transform(f))[0] > ml.regression_metrics(without.transform(f))[0]
    assert dict(ml.feature_importances(full, ml.TEMPERATURE_FEATURES))["yesterday_tmax"] > 0.2


def test_gbt_fit_save_load_predict(spark, tmp_path):
    f = ml.previous_day_features(derived.tmax_daily(spark, SF001))
    f = hash_split(f.withColumn("_id", F.concat_ws(":", "station", F.col("date").cast("string"))), "_id")
    model = ml.gbt_pipeline(max_iter=3).fit(f.where("split = 'train'"))
    path = str(tmp_path / "model")
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    pred = loaded.transform(f.where("split = 'validation'"))
    r2, rmse = ml.regression_metrics(pred)
    exact = ml.exact_regression_metrics(pred.withColumn("prediction", F.round("prediction", 2)),
                                        "tmax", "prediction").collect()[0]
    assert rmse > 0 and exact.rmse == pytest.approx(rmse, rel=1e-3)
    imp = ml.feature_importances(loaded, ml.TEMPERATURE_FEATURES)
    assert tuple(n for n, _ in imp) == ml.TEMPERATURE_FEATURES and sum(v for _, v in imp) == pytest.approx(1.0)
    one = f.limit(1)
    assert isinstance(ml.predict_one(loaded, one), float)


def test_mlp_layers_follow_label_count_and_accuracy(spark):
    c = ml.colour_features(derived.colours(spark, SF001), space="lab")
    n_labels = c.select(F.count_distinct("word")).first()[0]
    model = ml.mlp_pipeline(n_labels, max_iter=5).fit(c)
    assert model.stages[-1].getLayers()[-1] == n_labels
    pred = ml.with_predicted_label(model, model.transform(c))
    acc = ml.accuracy(pred)
    exact = ml.exact_accuracy(pred, "label", "prediction").collect()[0].accuracy
    assert acc == pytest.approx(exact)
    labels = ml.label_map(model)
    assert set(labels.values()) == {r.word for r in c.select("word").distinct().collect()}


def test_train_test_tomorrow_flow(spark, tmp_path):
    daily = derived.tmax_daily(spark, SF001)
    path = str(tmp_path / "tmax-model")
    model, (r2, rmse) = ml.train_temperature_model(daily, path, max_iter=3)
    assert rmse > 0
    r2_t, rmse_t = ml.score_temperature_model(path, daily)
    assert rmse_t > 0
    y = ml.predict_tomorrow(path, spark, "S1", datetime.date(2000, 8, 1), 5000.0)
    assert isinstance(y, float)


def test_colour_model_and_prediction_grid(spark):
    colours = derived.colours(spark, SF001)
    model, acc = ml.train_colour_model(colours, max_iter=5)
    assert 0.0 <= acc <= 1.0
    grid = ml.prediction_grid(model, ml.lab_grid(spark, 70.0, 8))
    rows_ = grid.collect()
    assert len(rows_) == 64
    assert {r.predicted_word for r in rows_} <= set(COLOUR_RGB)
    assert all((r.word_R, r.word_G, r.word_B) == COLOUR_RGB[r.predicted_word] for r in rows_)
    assert len({(r.labA, r.labB) for r in rows_}) == 64
    assert all(0 <= r.R <= 255 for r in rows_)


def test_sql_stages_load_in_another_session(spark, tmp_path):
    """The saved model holds its features: no library code is needed to apply it."""
    daily = derived.tmax_daily(spark, SF001)
    model = ml.gbt_pipeline(max_iter=2, with_sql_stage=True).fit(daily)
    model.write().save(str(tmp_path / "m"))
    want = rows(model.transform(daily), "station", "date", "yesterday_tmax", "prediction")
    stored = str(tmp_path / "daily")
    daily.write.parquet(stored)
    code = f"""
from pyspark.sql import SparkSession
from pyspark.ml import PipelineModel
import sys
s = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
out = PipelineModel.load({str(tmp_path / "m")!r}).transform(s.read.parquet({stored!r}))
out.select("station", "date", "yesterday_tmax", "prediction").write.parquet({str(tmp_path / "out")!r})
assert not any(m.startswith("tessera") for m in sys.modules)
"""
    import subprocess
    import sys
    subprocess.run([sys.executable, "-c", code], check=True, cwd=tmp_path, capture_output=True, timeout=300)
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == want and len(want) > 100


def test_lab_stage_equals_column_expressions(spark):
    from tessera.functions.colour import rgb_to_lab
    greys = [(v, v, v, "grey") for v in (0, 10, 11, 150, 255)]
    c = spark.createDataFrame([(*rgb, w) for w, rgb in COLOUR_RGB.items()] + greys, "R int, G int, B int, word string")
    a = rows(ml.lab_stage(("R", "G", "B", "word")).transform(c))
    b = rows(rgb_to_lab(c), "R", "G", "B", "word", "labL", "labA", "labB")
    assert [x[:4] for x in a] == [x[:4] for x in b]
    assert all(x == pytest.approx(y, abs=1e-9) for p, q in zip(a, b) for x, y in zip(p[4:], q[4:]))


def test_ablation_rows(spark):
    f = ml.previous_day_features(derived.tmax_daily(spark, SF001))
    f = hash_split(f.withColumn("_id", F.concat_ws(":", "station", F.col("date").cast("string"))), "_id")
    sets = {"all": ml.TEMPERATURE_FEATURES, "place": ("latitude", "longitude"), "one": ("yesterday_tmax",)}
    got = {r.name: r for r in ml.ablation(f, sets, max_iter=2, parallelism=3).collect()}
    assert set(got) == set(sets) and got["all"].r2 > got["place"].r2
    for name, features in sets.items():
        assert got[name].n_features == len(features) and set(got[name].importances) == set(features)
        assert sum(got[name].importances.values()) == pytest.approx(1.0) and got[name].rmse > 0
    one = ml.gbt_pipeline(("yesterday_tmax",), max_iter=2).fit(f.where("split = 'train'"))
    r2, rmse = ml.regression_metrics(one.transform(f.where("split = 'validation'")))
    assert (got["one"].r2, got["one"].rmse) == (pytest.approx(r2), pytest.approx(rmse))


def test_boosting_stops_early(spark):
    f = ml.previous_day_features(derived.tmax_daily(spark, SF001)).withColumn("held", F.dayofmonth("date") > 20)
    model = ml.gbt_pipeline(max_iter=40, validation="held", tolerance=0.05, checkpoint_interval=2).fit(f)
    assert 1 <= ml.n_trees(model) < 40


def test_next_day_of_every_station(spark):
    d = datetime.date
    daily = spark.createDataFrame(
        [("A", d(2015, 12, 30), 1.0, 2.0, 3.0, 5.0), ("A", d(2015, 12, 31), 1.0, 2.0, 3.0, 6.0), ("B", d(2016, 2, 28), 0.0, 0.0, 0.0, 9.0)],
        "station string, date date, latitude double, longitude double, elevation double, tmax double")
    model = ml.gbt_pipeline(max_iter=2).fit(ml.previous_day_features(derived.tmax_daily(spark, SF001)))
    got = ml.predict_next_day(model, daily)
    assert rows(got, "station", "date", "yesterday_tmax") == [("A", d(2016, 1, 1), 6.0), ("B", d(2016, 2, 29), 9.0)]
    assert got.where("prediction IS NULL").count() == 0


def test_colour_fit_reads_rows_in_every_core(spark, tmp_path):
    from tessera.operators.partitioning import cores
    from tessera.plans.queries import _colour_model
    spark.range(4000).select(F.col("id").alias("p_partkey")).coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    rows, model = _colour_model(spark, str(tmp_path))
    held = rows.rdd.mapPartitions(lambda it: [sum(1 for _ in it)]).collect()
    assert sum(held) == 4000 and len(held) >= cores(rows) and min(held) > 0
    assert len(model.stages) == 2


def test_fit_behind_a_sql_stage_stores_its_rows(spark):
    daily = spark.range(60).selectExpr(
        "concat('S', id % 3) AS station", "date_add(DATE'2024-01-01', CAST(id / 3 AS INT)) AS date", "1.0D AS latitude",
        "2.0D AS longitude", "3.0D AS elevation", "CAST(id AS DOUBLE) AS tmax")
    model, features = ml.fit_stored(ml.gbt_pipeline(max_iter=2, with_sql_stage=True), daily)
    assert features.count() == 57 and "Join" not in features._jdf.queryExecution().optimizedPlan().toString()
    key = ["station", "date", "prediction"]
    by_all = model.transform(daily).select(key).collect()
    assert sorted(by_all) == sorted(PipelineModel(model.stages[1:]).transform(features).select(key).collect())


def test_sql_stage_predictions_joins_days_once(spark):
    from conftest import SF01
    from tessera.plans.queries import QUERIES
    plan = QUERIES["sql_stage_predictions"](spark, SF01)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner") == 2      # the days of the loaded model's stage; with the fitted predictions
