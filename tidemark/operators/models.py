"""Churn classifiers on the user feature table: fit, compare, tune, explain."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import reports
from tidemark.operators.quality import columns_except
from tidemark.operators.split import train_and_test
from tidemark.sources import stored

CATEGORICAL = ["gender", "state", "device"]
NOT_FEATURES = ["label", "userId"]

# Bins of the tree models and the grids of the tuning runs.
MAX_BINS = 60
SCRIPT_GRID = {"maxIter": [50, 100, 500], "regParam": [0.01, 0.05, 0.1]}
NOTEBOOK_GRID = {"maxIter": [50, 100], "regParam": [0.01, 0.05]}
FOLDS = 3
SEED = 2022


def input_columns(features: DataFrame) -> list[str]:
    """Vector inputs in a fixed order: numbers as in the table, then the indexes."""
    numbers = columns_except(features.columns, NOT_FEATURES, CATEGORICAL)
    return numbers + [f"{name}_idx" for name in CATEGORICAL]


def feature_pipeline(features: DataFrame, handle_invalid: str = "error") -> Pipeline:
    """String indexes and one vector; unseen strings get an index of their own."""
    indexer = StringIndexer(
        inputCols=CATEGORICAL,
        outputCols=[f"{name}_idx" for name in CATEGORICAL],
        handleInvalid="keep",
    )
    assembler = VectorAssembler(
        inputCols=input_columns(features), outputCol="features", handleInvalid=handle_invalid
    )
    return Pipeline(stages=[indexer, assembler])


def classifiers() -> dict[str, Estimator]:
    """The five classifiers that are compared."""
    return {
        "logistic_regression": LogisticRegression(),
        "linear_svm": LinearSVC(),
        "decision_tree": DecisionTreeClassifier(maxBins=MAX_BINS, seed=SEED),
        "random_forest": RandomForestClassifier(maxBins=MAX_BINS, seed=SEED),
        "gradient_boosting": GBTClassifier(maxBins=MAX_BINS, seed=SEED),
    }


def require_two_classes(train: DataFrame) -> None:
    """Linear models cannot be fitted to one class; say so before they start."""
    found = [row.label for row in train.select("label").distinct().limit(3).collect()]
    if len(found) != 2:
        raise ValueError(f"training rows hold labels {sorted(found)}, two are needed")


def prepare(
    features: DataFrame, handle_invalid: str = "error"
) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """(fitted feature pipeline, train, test) with vectors.

    Split by hash of the user; the indexes are fitted on the training part only.
    """
    table = stored(features, "features")
    train, test = train_and_test(table, "userId", seed=SEED)
    fitted = feature_pipeline(table, handle_invalid).fit(train)
    keep = ["userId", "label", "features"]
    return fitted, fitted.transform(train).select(*keep), fitted.transform(test).select(*keep)


def fit_models(train: DataFrame, models: dict[str, Estimator] | None = None) -> dict[str, Transformer]:
    """The classifiers, each fitted on the training rows."""
    require_two_classes(train)
    rows = stored(train, "train")
    return {name: model.fit(rows) for name, model in (models or classifiers()).items()}


def predictions(fitted: dict[str, Transformer], test: DataFrame) -> DataFrame:
    """(model, userId, label, prediction): every model's prediction for every row, in one table."""
    results = [
        model.transform(test).select(F.lit(name).alias("model"), "userId", "label", "prediction")
        for name, model in fitted.items()
    ]
    return reduce(DataFrame.unionByName, results)


def compare_models(
    train: DataFrame, test: DataFrame, models: dict[str, Estimator] | None = None
) -> DataFrame:
    """(model, accuracy, f1) on the test rows; all models are scored in one job."""
    return reports.accuracy_and_f1(predictions(fit_models(train, models), test), ["model"])


def evaluators() -> dict[str, MulticlassClassificationEvaluator]:
    """The built-in evaluators of the two reported metrics."""
    return {
        name: MulticlassClassificationEvaluator(metricName=name) for name in ("accuracy", "f1")
    }


def tune_svc(
    train: DataFrame,
    grid: dict[str, list] | None = None,
    folds: int = FOLDS,
    parallelism: int = 4,
) -> CrossValidatorModel:
    """Cross-validated grid search for the linear SVM by F1.

    Folds come from a hash of the user, so they do not change with partitioning.
    """
    require_two_classes(train)
    svc = LinearSVC()
    builder = ParamGridBuilder()
    for name, values in (grid or SCRIPT_GRID).items():
        builder = builder.addGrid(svc.getParam(name), values)
    search = CrossValidator(
        estimator=Pipeline(stages=[svc]),
        estimatorParamMaps=builder.build(),
        evaluator=evaluators()["f1"],
        numFolds=folds,
        parallelism=parallelism,
        foldCol="fold",
        collectSubModels=True,
        seed=SEED,
    )
    return search.fit(stored(with_fold(train, folds), "folds"))


def with_fold(train: DataFrame, folds: int = FOLDS) -> DataFrame:
    """Add ``fold``, by a hash of the user."""
    return train.withColumn("fold", F.pmod(F.xxhash64("userId", F.lit(SEED)), F.lit(folds)).cast("int"))


def fold_predictions(tuned: CrossValidatorModel, train: DataFrame) -> DataFrame:
    """(params, fold, label, prediction): what the models of the search said of the rows they did not see."""
    folded = stored(with_fold(train, len(tuned.subModels)), "folds")
    results = [
        model.transform(folded.filter(F.col("fold") == fold)).select(
            F.lit(point).alias("params"), "fold", "label", "prediction"
        )
        for fold, models in enumerate(tuned.subModels)
        for point, model in zip(_points(tuned), models, strict=True)
    ]
    return reduce(DataFrame.unionByName, results)


def best_parameters(spark: SparkSession, tuned: CrossValidatorModel) -> DataFrame:
    """(param, value) of the winning model."""
    params = tuned.bestModel.stages[-1].extractParamMap()
    rows = sorted((param.name, str(value)) for param, value in params.items())
    return spark.createDataFrame(rows, "param string, value string")


def _points(tuned: CrossValidatorModel) -> list[str]:
    """The grid points as text, in the order of the search."""
    maps = tuned.getEstimatorParamMaps()
    return [", ".join(f"{p.name}={v}" for p, v in sorted(m.items(), key=lambda i: i[0].name)) for m in maps]


def grid_scores(spark: SparkSession, tuned: CrossValidatorModel) -> DataFrame:
    """(params, mean F1) for every grid point."""
    rows = [(point, float(score)) for point, score in zip(_points(tuned), tuned.avgMetrics, strict=True)]
    return spark.createDataFrame(rows, "params string, f1 double")


def coefficients(spark: SparkSession, svc, inputs: list[str]) -> DataFrame:
    """(feature, coefficient), largest first; names are those the vector was built from."""
    rows = [(n, float(c)) for n, c in zip(inputs, svc.coefficients.toArray(), strict=True)]
    table = spark.createDataFrame(rows, "feature string, coefficient double")
    return table.orderBy(F.desc("coefficient"), "feature")


def long_vectors(rows: DataFrame, key: str = "userId") -> DataFrame:
    """(key, position, value): one row per vector and position."""
    return rows.select(key, F.posexplode(vector_to_array("features")).alias("position", "value"))


def linear_margins(vectors: DataFrame, svc, key: str = "userId") -> DataFrame:
    """(key, margin) from long vectors: a join with the coefficients by position and one sum.

    The model predicts 1 where the margin is above its threshold.
    """
    rows = [(k, float(c)) for k, c in enumerate(svc.coefficients.toArray())]
    weights = vectors.sparkSession.createDataFrame(rows, "position int, coefficient double")
    joined = vectors.join(weights, "position")
    margin = F.sum(F.col("value") * F.col("coefficient")) + F.lit(float(svc.intercept))
    return joined.groupBy(key).agg(margin.alias("margin"))


def whole_model(prepared: PipelineModel, tuned: CrossValidatorModel) -> PipelineModel:
    """Feature stages and the winning model as one pipeline to save or score with."""
    return PipelineModel(stages=[*prepared.stages, *tuned.bestModel.stages])


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
