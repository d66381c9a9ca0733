"""Labelled messages: merging, expanding packed labels, cleaning, counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import display_name
from tidemark.operators.quality import to_rows

TEXT_COLUMNS = ["id", "message", "original", "genre"]


def merge_messages(messages: DataFrame, categories: DataFrame, null_keys: bool = False) -> DataFrame:
    """Inner join on ``id``; with ``null_keys`` nulls match each other."""
    if not null_keys:
        return messages.join(categories, on="id")
    right = categories.withColumnRenamed("id", "__id")
    return messages.join(right, messages.id.eqNullSafe(right["__id"])).drop("__id")


def _packed(text: str) -> Column:
    """``a-1;b-0`` as an array of (name, value) pairs."""
    return F.transform(
        F.split(F.col(text), ";"),
        lambda item: F.struct(
            F.split_part(item, F.lit("-"), F.lit(1)).alias("category"),
            F.get(F.split(item, "-"), F.lit(1)).cast("double").alias("value"),
        ),
    )


def category_names(df: DataFrame, column: str = "categories") -> DataFrame:
    """(name, position) rows: the category names that occur and their first position."""
    items = df.select(F.posexplode(F.split(column, ";")).alias("position", "item"))
    return items.groupBy(F.split_part("item", F.lit("-"), F.lit(1)).alias("name")).agg(
        F.min("position").alias("position")
    )


def expand_categories(df: DataFrame, names: list[str], column: str = "categories") -> DataFrame:
    """Replace the packed column by one number column per category.

    Values are found by name, so the order inside the packed text does not
    matter. A name that a row lacks gives null; a name that it repeats raises.
    """
    values = F.map_from_entries(_packed(column))
    return (
        df.withColumn("__values", values)
        .select(
            *[F.col(c) for c in df.columns if c != column],
            *[F.element_at("__values", name).alias(name) for name in names],
        )
    )


def categories_long(df: DataFrame, column: str = "categories") -> DataFrame:
    """(id, category, value) rows."""
    return df.select("id", F.inline(_packed(column)))


def name_mismatches(df: DataFrame, names: list[str], column: str = "categories") -> DataFrame:
    """Rows whose category names, in order, are not the expected ones."""
    found = F.transform(
        F.split(column, ";"), lambda item: F.split_part(item, F.lit("-"), F.lit(1))
    )
    wanted = F.lit(";".join(names))
    return df.select("id", F.array_join(found, ";").alias("names")).filter(
        ~F.col("names").eqNullSafe(wanted)
    )


def two_to_one(df: DataFrame, names: list[str]) -> DataFrame:
    """2 becomes 1 in the label columns; other columns keep their values."""
    return df.withColumns({n: F.when(F.col(n) == 2, F.lit(1.0)).otherwise(F.col(n)) for n in names})


def clean_merged(merged: DataFrame, names: list[str]) -> DataFrame:
    """Expand, drop repeated rows, then turn 2 into 1.

    Rows that become equal only by the last step stay.
    """
    return two_to_one(expand_categories(merged, names).dropDuplicates(), names)


def clean_messages(messages: DataFrame, categories: DataFrame, names: list[str]) -> DataFrame:
    """Merge and clean in one plan, with the rows of ``clean_merged``.

    Both sides drop repeated rows before the join. Pairs of distinct rows are
    distinct, so nothing is left to drop after it, and copies of one id do not
    multiply each other. Both sides are dealt by id once; that serves the grouping
    by all columns and the join.
    """
    labels = expand_categories(categories, names).repartition("id").dropDuplicates()
    return two_to_one(messages.repartition("id").dropDuplicates().join(labels, on="id"), names)


def genre_counts(cleaned: DataFrame) -> DataFrame:
    """Messages per genre; rows without a genre are left out."""
    return (
        cleaned.filter(F.col("genre").isNotNull())
        .groupBy("genre")
        .agg(F.count("message").alias("num_messages"))
    )


def category_totals(cleaned: DataFrame, names: list[str]) -> DataFrame:
    """Number of messages of each category."""
    sums = cleaned.agg(*[F.sum(name).alias(name) for name in names])
    return to_rows(sums, {name: F.col(name) for name in names}, "category", "total")


def assigned_labels(cleaned: DataFrame, names: list[str]) -> DataFrame:
    """(id, display name, whether the label is set) rows."""
    rows = cleaned.unpivot(["id"], names, "category", "value")
    return rows.select(
        "id",
        display_name("category").alias("display_name"),
        F.coalesce(F.col("value") == 1, F.lit(False)).alias("assigned"),
    )


def assigned_from_map(scored: DataFrame, column: str = "labels") -> DataFrame:
    """The same rows from a map of label name to 0 or 1."""
    return scored.select("id", F.explode(column).alias("category", "value")).select(
        "id",
        display_name("category").alias("display_name"),
        (F.col("value") == 1).alias("assigned"),
    )
