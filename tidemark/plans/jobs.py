"""Whole jobs from files to stored tables, models and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import activity, messages, models, multilabel, prices, reports
from tidemark.plans import training
from tidemark.plans.churn import user_features
from tidemark.session import configure
from tidemark.sources import (
    read_calendar,
    read_categories,
    read_events,
    read_listings,
    read_messages,
    read_table,
    write_table,
)


def ingest_log(spark: SparkSession, source: str, target: str) -> DataFrame:
    """JSON activity log to a cleaned Parquet table.

    The feature job reads the log once for each kind of aggregate, and only the
    columns it needs; that is cheap on columns and dear on JSON.
    """
    configure(spark)
    write_table(activity.clean_log(read_events(spark, source)), target)
    return read_table(spark, target)


def churn_job(
    log: DataFrame, pages: list[str], model_path: str, grid: dict[str, list] | None = None
) -> DataFrame:
    """Features with a count for each page named, tuned linear SVM, saved model; returns accuracy and F1 on test users."""
    run = training.tune_churn(user_features(log, pages), grid)
    models.save_model(run.model, model_path)
    results = run.tuned.transform(run.test).withColumn("model", F.lit("linear_svm"))
    return reports.accuracy_and_f1(results, ["model"])


def message_etl(
    spark: SparkSession, messages_path: str, categories_path: str, names: list[str], target: str
) -> DataFrame:
    """Two CSV files to the cleaned table with one column per label named."""
    configure(spark)
    packed = read_categories(spark, categories_path)
    cleaned = messages.clean_messages(read_messages(spark, messages_path), packed, names)
    write_table(cleaned, target)
    return read_table(spark, target)


def message_training(
    table: DataFrame,
    model_path: str,
    grid: list[dict] | None = None,
    folds: int = multilabel.GRID_FOLDS,
    **options,
) -> DataFrame:
    """Grid search, fit, saved model; returns the report of every label on test rows."""
    names = [c for c in table.columns if c not in messages.TEXT_COLUMNS]
    train, test = training.split_messages(table)
    best, _ = multilabel.grid_search(train, names, grid, folds, **options)
    model = multilabel.fit_messages(train, names, best, **options)
    model.save(model_path)
    return multilabel.label_reports(model.score(test), names)


def price_job(
    spark: SparkSession, calendar_path: str, listings_path: str
) -> tuple[DataFrame, DataFrame]:
    """(mean price by date, mean price by district and date)."""
    configure(spark)
    parsed = prices.parse_calendar(read_calendar(spark, calendar_path))
    listings = read_listings(spark, listings_path)
    return prices.price_by_date(parsed), prices.price_by_district_date(parsed, listings)
