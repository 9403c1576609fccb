"""Spark ML pipelines: next-day temperature (GBT) and colour words (MLP).

Fitting is distributed by Spark ML; these helpers only build the
pipelines, the features and the metrics.  Metrics are also offered as
plain aggregates so they can be checked against SQL.
"""

from __future__ import annotations

from itertools import takewhile
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import IndexToString, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.colour import lab_statement, rgb_to_lab_cols
from ..functions.stats import significant
from .joins import materialize
from .partitioning import spread_rows

TEMPERATURE_FEATURES = ("latitude", "longitude", "elevation", "day_of_year", "yesterday_tmax")


def previous_day_features(daily: DataFrame) -> DataFrame:
    """(station, date, day_of_year, tmax, yesterday_tmax) and every further
    column of ``daily``; a day without a previous day is dropped.

    Each row is emitted under its own date and, as yesterday, under the next
    one; one aggregate by (station, date) brings both together.  Rows of the
    same station and date count as one (the largest value of each column).
    """
    extra = [c for c in daily.columns if c not in ("station", "date", "tmax")]
    now = F.struct(F.col("date").alias("date"), F.col("tmax").alias("tmax"),
                   F.lit(None).cast(daily.schema["tmax"].dataType).alias("yesterday_tmax"),
                   *[F.col(c).alias(c) for c in extra])
    then = F.struct(F.date_add("date", 1).alias("date"), F.lit(None).cast(daily.schema["tmax"].dataType).alias("tmax"),
                    F.col("tmax").alias("yesterday_tmax"),
                    *[F.lit(None).cast(daily.schema[c].dataType).alias(c) for c in extra])
    rows = daily.select("station", F.explode(F.array(now, then)).alias("_r")).select("station", "_r.*")
    both = rows.groupBy("station", "date").agg(
        *[F.max(c).alias(c) for c in ("tmax", "yesterday_tmax", *extra)])
    return both.where("tmax IS NOT NULL AND yesterday_tmax IS NOT NULL").select(
        "station", "date", F.dayofyear("date").alias("day_of_year"), "tmax", "yesterday_tmax", *extra)


PREVIOUS_DAY = """
SELECT today.station, today.date, dayofyear(today.date) AS day_of_year, today.tmax AS tmax,
       yesterday.tmax AS yesterday_tmax, today.latitude, today.longitude, today.elevation
FROM __THIS__ AS today INNER JOIN __THIS__ AS yesterday
  ON date_sub(today.date, 1) = yesterday.date AND today.station = yesterday.station
"""


def previous_day_stage() -> SQLTransformer:
    """The previous-day features as SQL text: a stage that any Spark session
    can load with the model, without this library.  It expects one row per
    station and date."""
    return SQLTransformer(statement=PREVIOUS_DAY)


def lab_stage(passthrough: tuple[str, ...] = ("word",)) -> SQLTransformer:
    """RGB to LAB as SQL text."""
    return SQLTransformer(statement=lab_statement(passthrough))


def gbt_pipeline(features=TEMPERATURE_FEATURES, label: str = "tmax", max_iter: int = 20, seed: int = 40,
                 with_sql_stage: bool = False, validation: str | None = None, tolerance: float = 0.01,
                 checkpoint_interval: int = 10) -> Pipeline:
    """Boosted trees over ``features``, with the previous-day SQL stage in
    front if asked for.  ``validation`` names a boolean column: its rows are
    held out, and boosting ends once a tree improves their error by less than
    ``tolerance``.  Every ``checkpoint_interval`` trees the residuals' lineage
    is cut in the shared checkpoint folder, if one is set."""
    stages = [previous_day_stage()] if with_sql_stage else []
    early = {"validationIndicatorCol": validation, "validationTol": tolerance} if validation else {}
    trees = GBTRegressor(featuresCol="features", labelCol=label, maxIter=max_iter, seed=seed,
                         checkpointInterval=checkpoint_interval, **early)
    return Pipeline(stages=[*stages, VectorAssembler(inputCols=list(features), outputCol="features"), trees])


def fit_stored(pipeline: Pipeline, rows: DataFrame) -> tuple[PipelineModel, DataFrame]:
    """(the fitted pipeline, the stored output of its leading SQL stages).  A
    fit reads its rows several times; stored, they are made once."""
    stages = pipeline.getStages()
    head = list(takewhile(lambda s: isinstance(s, SQLTransformer), stages))
    stored = materialize(PipelineModel(head).transform(rows))
    return PipelineModel([*head, *Pipeline(stages=stages[len(head):]).fit(stored).stages]), stored


def n_trees(model: PipelineModel) -> int:
    return model.stages[-1].getNumTrees


def ablation(rows: DataFrame, feature_sets: dict[str, tuple[str, ...]], label: str = "tmax", split: str = "split",
             max_iter: int = 20, seed: int = 40, parallelism: int = 2) -> DataFrame:
    """One row per feature set: name, n_features, r2 and rmse on the validation
    rows, importances (map of feature to share).

    ``rows`` holds every feature, the label and a ``split`` of 'train' and
    'validation'.  They are stored once; the fits (``Pipeline.fitMultiple``)
    run ``parallelism`` at a time on that copy, so one fit's serial parts
    overlap with another's tasks.
    """
    columns = sorted({c for names in feature_sets.values() for c in names})
    stored = materialize(rows.select(*columns, label, split))
    train, held = stored.where(F.col(split) == "train"), stored.where(F.col(split) == "validation")
    assembler = VectorAssembler(outputCol="features")
    pipeline = Pipeline(stages=[assembler, GBTRegressor(featuresCol="features", labelCol=label, maxIter=max_iter, seed=seed)])
    names = list(feature_sets)
    fits = pipeline.fitMultiple(train, [{assembler.inputCols: list(feature_sets[n])} for n in names])

    def judged(_) -> tuple:
        i, model = next(fits)
        r2, rmse = regression_metrics(model.transform(held), label)
        return names[i], len(feature_sets[names[i]]), r2, rmse, dict(feature_importances(model, feature_sets[names[i]]))

    with ThreadPool(max(1, min(parallelism, len(names)))) as pool:
        found = pool.map(inheritable_thread_target(rows.sparkSession)(judged), names)
    return rows.sparkSession.createDataFrame(
        found, "name string, n_features int, r2 double, rmse double, importances map<string,double>")


def predict_next_day(model: PipelineModel, daily: DataFrame) -> DataFrame:
    """(station, date, yesterday_tmax, prediction) for the day after each
    station's last one: all stations in one job.  ``daily`` has one row per
    station and date; the model starts behind the previous-day features."""
    last = daily.groupBy("station").agg(F.max("date").alias("date"))
    now = daily.join(last, ["station", "date"])
    tomorrow = now.withColumns({"date": F.date_add("date", 1), "yesterday_tmax": F.col("tmax")}) \
                  .withColumn("day_of_year", F.dayofyear("date"))
    return model.transform(tomorrow).select("station", "date", "yesterday_tmax", "prediction")


def regression_metrics(pred: DataFrame, label: str = "tmax", prediction: str = "prediction"):
    """(r2, rmse) with Spark ML's evaluator."""
    ev = RegressionEvaluator(labelCol=label, predictionCol=prediction)
    return ev.setMetricName("r2").evaluate(pred), ev.setMetricName("rmse").evaluate(pred)


def exact_regression_metrics(pred: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row (n, r2, rmse): the residuals' squares against the label's
    variance (a central moment, so large values neither cancel nor overflow)."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    m = pred.where(y.isNotNull() & p.isNotNull()).agg(
        F.count(F.lit(1)).alias("n"), F.avg((y - p) * (y - p)).alias("mse"), F.var_pop(y).alias("var"))
    return m.select("n", significant(F.when(F.col("var") > 0, F.lit(1.0) - F.col("mse") / F.col("var"))).alias("r2"),
                    significant(F.sqrt("mse")).alias("rmse"))


def feature_importances(model: PipelineModel, features) -> list[tuple[str, float]]:
    """(feature, importance) pairs of the pipeline's tree model."""
    imp = model.stages[-1].featureImportances
    return [(f, float(imp[i])) for i, f in enumerate(features)]


def predict_one(model: PipelineModel, df: DataFrame, prediction: str = "prediction"):
    """Prediction column by name (not by position) for a one-row input."""
    return model.transform(df).select(prediction).first()[0]


def colour_features(df: DataFrame, r="R", g="G", b="B", space: str = "rgb") -> DataFrame:
    """Append a ``features`` vector from RGB or from LAB."""
    if space == "lab":
        lab = rgb_to_lab_cols(F.col(r), F.col(g), F.col(b))
        df = df.withColumns({"labL": lab[0], "labA": lab[1], "labB": lab[2]})
        cols = ["labL", "labA", "labB"]
    else:
        cols = [r, g, b]
    return VectorAssembler(inputCols=cols, outputCol="features").transform(df)


def mlp_pipeline(n_labels: int, label_col: str = "word", hidden: int = 30,
                 max_iter: int = 100, seed: int = 40) -> Pipeline:
    """StringIndexer + MLP with layers [3, hidden, n_labels] (last layer =
    number of labels, not a fixed 11) + IndexToString."""
    return Pipeline(stages=[
        StringIndexer(inputCol=label_col, outputCol="label"),
        MultilayerPerceptronClassifier(layers=[3, hidden, n_labels], maxIter=max_iter, seed=seed),
    ])


def with_predicted_label(model: PipelineModel, pred: DataFrame, out: str = "predicted_word") -> DataFrame:
    indexer = [s for s in model.stages if hasattr(s, "labels")][0]
    return IndexToString(inputCol="prediction", outputCol=out,
                         labels=indexer.labels).transform(pred)


def label_map(model: PipelineModel) -> dict[float, str]:
    """index -> label of the pipeline's StringIndexerModel."""
    indexer = [s for s in model.stages if hasattr(s, "labels")][0]
    return {float(i): lab for i, lab in enumerate(indexer.labels)}


def accuracy(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> float:
    return MulticlassClassificationEvaluator(labelCol=label, predictionCol=prediction,
                                             metricName="accuracy").evaluate(pred)


def exact_accuracy(pred: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row (n, accuracy) as a plain aggregate."""
    hit = (F.col(label) == F.col(prediction)).cast("int")
    return pred.agg(F.count(F.lit(1)).alias("n"),
                    (F.sum(hit).cast("double") / F.count(F.lit(1))).alias("accuracy"))


# --- job flows: train / test / predict tomorrow; colour model + grid ----------

def train_temperature_model(daily: DataFrame, model_path: str,
                            features=TEMPERATURE_FEATURES, seed: int = 40,
                            max_iter: int = 20):
    """Fit the next-day GBT on a 75 % md5 split of (station, date) and save it.

    Returns ``(model, metrics)`` where metrics are (r2, rmse) on the held-out
    validation rows (not on the training rows).
    """
    from .sampling import hash_split
    f = previous_day_features(daily)
    f = hash_split(f.withColumn("_id", F.concat_ws(":", "station", F.col("date").cast("string"))),
                   "_id", seed)
    model = gbt_pipeline(features, max_iter=max_iter, seed=seed).fit(f.where(F.col("split") == "train"))
    model.write().overwrite().save(model_path)
    return model, regression_metrics(model.transform(f.where(F.col("split") == "validation")))


def score_temperature_model(model_path: str, daily: DataFrame):
    """(r2, rmse) of a saved model on another daily series."""
    model = PipelineModel.load(model_path)
    return regression_metrics(model.transform(previous_day_features(daily)))


def predict_tomorrow(model_path: str, spark, station: str, today, today_tmax: float,
                     latitude: float = 0.0, longitude: float = 0.0, elevation: float = 0.0) -> float:
    """Tomorrow's tmax from today's value, the station's place and tomorrow's
    day of year (the prediction column is read by name, not by position)."""
    import datetime
    tomorrow = today + datetime.timedelta(days=1)
    row = spark.createDataFrame(
        [(station, tomorrow, tomorrow.timetuple().tm_yday, None, float(today_tmax),
          float(latitude), float(longitude), float(elevation))],
        "station string, date date, day_of_year int, tmax double, yesterday_tmax double, "
        "latitude double, longitude double, elevation double")
    return predict_one(PipelineModel.load(model_path), row)


def train_colour_model(colours: DataFrame, space: str = "lab", seed: int = 40,
                       max_iter: int = 100):
    """MLP colour-word model on RGB or LAB features; returns (model, validation accuracy)."""
    from .sampling import hash_split
    c = materialize(spread_rows(hash_split(colour_features(colours, space=space), "p_partkey", seed)))
    n_labels = c.select(F.count_distinct("word")).first()[0]
    model = mlp_pipeline(n_labels, max_iter=max_iter, seed=seed).fit(c.where(F.col("split") == "train"))
    return model, accuracy(model.transform(c.where(F.col("split") == "validation")))


def prediction_grid(model: PipelineModel, grid: DataFrame, space: str = "lab") -> DataFrame:
    """Predict a colour word for every cell of a LAB grid and attach the
    word's representative RGB: (labA, labB, R, G, B, predicted_word,
    word_R, word_G, word_B).  ``grid`` holds labL, labA, labB."""
    from ..functions.colour import colour_table, lab_to_rgb_cols
    rgb = lab_to_rgb_cols(F.col("labL"), F.col("labA"), F.col("labB"))
    # features are those of the displayable colour; the cell keeps its own place
    cells = grid.select(F.col("labA").alias("_a"), F.col("labB").alias("_b"), *[(c * F.lit(255.0)).alias(n) for c, n in zip(rgb, "RGB")],
                        F.lit(label_map(model)[0.0]).alias("word"))
    pred = with_predicted_label(model, model.transform(colour_features(cells, space=space)))
    words = F.broadcast(colour_table(grid.sparkSession).select(
        F.col("word").alias("predicted_word"), F.col("R").alias("word_R"),
        F.col("G").alias("word_G"), F.col("B").alias("word_B")))
    return pred.join(words, "predicted_word", "left").select(
        F.col("_a").alias("labA"), F.col("_b").alias("labB"), "R", "G", "B", "predicted_word", "word_R", "word_G", "word_B")


def lab_grid(spark, lum: float = 70.0, resolution: int = 256) -> DataFrame:
    """A resolution x resolution lattice over a, b in [-100, 100] at L = lum."""
    step = 200.0 / (resolution - 1)
    ids = spark.range(resolution * resolution)
    return ids.select(F.lit(float(lum)).alias("labL"),
                      (F.lit(-100.0) + (F.col("id") % resolution).cast("double") * step).alias("labA"),
                      (F.lit(-100.0) + F.floor(F.col("id") / resolution).cast("double") * step)
                      .alias("labB"))
