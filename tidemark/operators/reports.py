"""Classification metrics from confusion counts.

Predictions are reduced to one row per (group, label, prediction) in a single
pass; all metrics come from that small table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def confusion(
    results: DataFrame,
    keys: list[str],
    label: str = "label",
    prediction: str = "prediction",
) -> DataFrame:
    """Number of rows per (keys..., label, prediction)."""
    return results.groupBy(
        *keys, F.col(label).cast("double").alias("label"), F.col(prediction).cast("double").alias("prediction")
    ).agg(F.count(F.lit(1)).alias("n"))


def class_metrics(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Precision, recall, F1 and support per class; a ratio without rows is 0."""
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    as_label = counts.select(
        *keys,
        F.col("label").alias("class"),
        F.col("n").alias("support"),
        F.lit(0).cast("bigint").alias("predicted"),
        hit.cast("bigint").alias("hits"),
    )
    as_prediction = counts.select(
        *keys,
        F.col("prediction").alias("class"),
        F.lit(0).cast("bigint").alias("support"),
        F.col("n").alias("predicted"),
        F.lit(0).cast("bigint").alias("hits"),
    )
    sums = as_label.unionByName(as_prediction).groupBy(*keys, "class").agg(
        *[F.sum(c).alias(c) for c in ("support", "predicted", "hits")]
    )
    zero = F.lit(0.0)
    return sums.select(
        *keys,
        "class",
        F.coalesce(F.try_divide("hits", "predicted"), zero).alias("precision"),
        F.coalesce(F.try_divide("hits", "support"), zero).alias("recall"),
        F.coalesce(F.try_divide(2 * F.col("hits"), F.col("support") + F.col("predicted")), zero).alias("f1"),
        "support",
        "hits",
    )


def _summaries(metrics: DataFrame, keys: list[str]) -> DataFrame:
    total = F.sum("support")
    return metrics.groupBy(*keys).agg(
        total.alias("support"),
        (F.sum("hits") / total).alias("accuracy"),
        *[F.avg(m).alias(f"macro_{m}") for m in ("precision", "recall", "f1")],
        *[(F.sum(F.col(m) * F.col("support")) / total).alias(f"weighted_{m}") for m in ("precision", "recall", "f1")],
    )


def classification_report(
    results: DataFrame,
    keys: list[str],
    label: str = "label",
    prediction: str = "prediction",
) -> DataFrame:
    """One row per class, and rows ``accuracy``, ``macro avg`` and ``weighted avg``."""
    metrics = class_metrics(confusion(results, keys, label, prediction), keys)
    sums = _summaries(metrics, keys)
    names = ["precision", "recall", "f1", "support"]
    per_class = metrics.select(*keys, F.col("class").cast("int").cast("string").alias("row"), *names)
    empty = F.lit(None).cast("double")
    rows = F.array(
        F.struct(
            F.lit("accuracy").alias("row"),
            empty.alias("precision"),
            empty.alias("recall"),
            F.col("accuracy").alias("f1"),
            "support",
        ),
        *[
            F.struct(
                F.lit(f"{kind} avg").alias("row"),
                F.col(f"{kind}_precision").alias("precision"),
                F.col(f"{kind}_recall").alias("recall"),
                F.col(f"{kind}_f1").alias("f1"),
                "support",
            )
            for kind in ("macro", "weighted")
        ],
    )
    return per_class.unionByName(sums.select(*keys, F.inline(rows)))


def accuracy_and_f1(
    results: DataFrame,
    keys: list[str],
    label: str = "label",
    prediction: str = "prediction",
) -> DataFrame:
    """Accuracy and class-weighted F1 per group."""
    metrics = class_metrics(confusion(results, keys, label, prediction), keys)
    return _summaries(metrics, keys).select(
        *keys, "accuracy", F.col("weighted_f1").alias("f1")
    )
