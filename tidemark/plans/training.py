"""Training and scoring jobs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.tuning import CrossValidatorModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import models, multilabel, reports
from tidemark.operators.split import with_exact_side
from tidemark.plans.churn import fill_song_measures
from tidemark.session import scratch_path
from tidemark.sources import Units, read_table, stored
from tidemark.streaming import scoring


@dataclass
class ChurnRun:
    """A tuned churn model and what it was fitted on."""

    tuned: CrossValidatorModel
    model: PipelineModel
    inputs: list[str]
    train: DataFrame
    test: DataFrame


def churn_parts(features: DataFrame) -> tuple[PipelineModel, list[str], DataFrame, DataFrame]:
    filled = fill_song_measures(features)
    prepared, train, test = models.prepare(filled)
    return prepared, models.input_columns(filled), train, test


def compare_churn_models(features: DataFrame) -> DataFrame:
    _, _, train, test = churn_parts(features)
    return models.compare_models(train, test)


def tune_churn(features: DataFrame, grid: dict[str, list] | None = None, folds: int = models.FOLDS) -> ChurnRun:
    prepared, inputs, train, test = churn_parts(features)
    tuned = models.tune_svc(train, grid, folds)
    return ChurnRun(tuned, models.whole_model(prepared, tuned), inputs, train, test)


def split_messages(cleaned: DataFrame, train: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Training and test messages of exact sizes.

    The side follows from the id, so nothing has to be kept between the two.
    """
    sided = with_exact_side(cleaned, "id", train)
    return (
        sided.filter("side = 'train'").drop("side"),
        sided.filter("side = 'test'").drop("side"),
    )


def message_report(cleaned: DataFrame, names: list[str], params: dict | None = None, **options) -> DataFrame:
    """Fit on the training part and report every label on the test part."""
    train, test = split_messages(cleaned)
    model = multilabel.fit_messages(train, names, params, **options)
    return multilabel.label_reports(model.score(test), names)


# Values that are computed in two ways, in another order of rows, may differ in their last digits.
_CLOSE = 1e-9


def _close(left: str, right: str) -> Column:
    """Equal but for rounding; null is equal to null."""
    near = F.abs(F.col(left) - F.col(right)) < _CLOSE
    return F.coalesce(near, F.col(left).isNull() & F.col(right).isNull())


def checked_metrics(predictions: DataFrame) -> DataFrame:
    """(model, users, binary, same_accuracy, same_f1): metrics of the confusion table against Spark's evaluators."""
    scored = stored(predictions, "predictions")
    rows = []
    for name in [row.model for row in scored.select("model").distinct().collect()]:
        own = scored.filter(F.col("model") == name)
        rows.append((name, *[float(e.evaluate(own)) for e in models.evaluators().values()]))
    expected = scored.sparkSession.createDataFrame(rows, "model string, accuracy_of double, f1_of double")
    shape = scored.groupBy("model").agg(
        F.count_distinct("userId").alias("users"), F.every(F.col("prediction").isin(0.0, 1.0)).alias("binary")
    )
    found = reports.accuracy_and_f1(scored, ["model"]).join(expected, "model").join(shape, "model")
    return found.select(
        "model", "users", "binary", _close("accuracy", "accuracy_of").alias("same_accuracy"), _close("f1", "f1_of").alias("same_f1")
    )


# A report by its definition, class by class.
_REPORT = """
WITH known AS (SELECT * FROM {scored} WHERE label IS NOT NULL),
classes AS (SELECT category, label AS class FROM known UNION SELECT category, prediction FROM known),
counts AS (
  SELECT category, class, count_if(label = class) AS support, count_if(prediction = class) AS predicted,
         count_if(label = class AND prediction = class) AS hits
  FROM known JOIN classes USING (category) GROUP BY category, class),
scores AS (
  SELECT *, coalesce(try_divide(hits, predicted), 0D) AS p, coalesce(try_divide(hits, support), 0D) AS r,
         coalesce(try_divide(2 * hits, support + predicted), 0D) AS f FROM counts)
SELECT category, CAST(CAST(class AS INT) AS STRING) AS row, p AS p_of, r AS r_of, f AS f_of FROM scores
UNION ALL SELECT category, 'accuracy', NULL, NULL, avg(CAST(label = prediction AS INT)) FROM known GROUP BY category
UNION ALL SELECT category, 'macro avg', avg(p), avg(r), avg(f) FROM scores GROUP BY category
UNION ALL SELECT category, 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support),
  sum(f * support) / sum(support) FROM scores GROUP BY category
"""


def checked_report(cleaned: DataFrame, names: list[str], params: dict | None = None, **options) -> DataFrame:
    """(category, row, support, same): the rows of :func:`message_report` against the predictions they come from."""
    train, test = split_messages(cleaned)
    model = multilabel.fit_messages(train, names, params, **options)
    scored = stored(multilabel.predictions_long(model.score(test), names), "predictions")
    report = reports.classification_report(scored.filter(F.col("label").isNotNull()), ["category"])
    expected = cleaned.sparkSession.sql(_REPORT, scored=scored)
    same = _close("precision", "p_of") & _close("recall", "r_of") & _close("f1", "f_of")
    return report.join(expected, ["category", "row"]).select("category", "row", "support", same.alias("same"))


def checked_search(cleaned: DataFrame, names: list[str], grid: list[dict], folds: int = multilabel.GRID_FOLDS) -> DataFrame:
    """(params, fits, same): each point's finished fits, and its score against the predictions of those fits."""
    spark = cleaned.sparkSession
    work = scratch_path(spark, "search")
    _, scores = multilabel.grid_search(cleaned, names, grid, folds, parallelism=8, work=work)
    units = Units(spark, work)
    fits = [unit for unit in units.names() if unit.startswith("predictions/")]
    points = [", ".join(f"{k}={v}" for k, v in sorted(params.items())) for params in grid]
    counted = [(p, k, sum(f"/point={k}/" in unit for unit in fits)) for k, p in enumerate(points)]
    expected = spark.createDataFrame(counted, "params string, point int, fits bigint")
    rows = read_table(spark, units.location("predictions"))
    # The share of rows with no label wrong, per fold, then the mean of the folds.
    means = spark.sql(
        """SELECT point, avg(score) AS mean FROM (
             SELECT point, fold, avg(CAST(wrong = 0 AS INT)) AS score FROM (
               SELECT point, fold, row, count_if(NOT right) AS wrong FROM {rows} GROUP BY point, fold, row)
             GROUP BY point, fold)
           GROUP BY point""",
        rows=rows,
    )
    found = scores.join(expected, "params").join(means, "point")
    return found.select("params", "fits", _close("score", "mean").alias("same"))


def saved_message_model(cleaned: DataFrame, names: list[str], params: dict | None = None, **options) -> multilabel.MessageModel:
    """Fit on all rows, save, and load again."""
    spark = cleaned.sparkSession
    path = scratch_path(spark, "message-model")
    multilabel.fit_messages(cleaned, names, params, **options).save(path)
    return multilabel.MessageModel.load(spark, path)


def stream_scores(messages: DataFrame, model: multilabel.MessageModel) -> DataFrame:
    """Run the stream to its end and read what it wrote."""
    spark = messages.sparkSession
    target, checkpoint = scratch_path(spark, "scores"), scratch_path(spark, "scores-log")
    scoring.score_stream(messages, model, target, checkpoint).awaitTermination()
    return scoring.read_scores(spark, target)
