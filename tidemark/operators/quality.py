"""Inspection and data-quality checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row: the number of nulls in each column, in one pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns or df.columns])


def nulls_where_null(df: DataFrame, given: str, columns: list[str]) -> DataFrame:
    """Null counts of ``columns`` over the rows where ``given`` is null."""
    return null_counts(df.filter(F.col(given).isNull()), columns)


def to_rows(one_row: DataFrame, columns: dict[str, Column], key: str, value: str) -> DataFrame:
    """Turn named columns of each row into (key, value) rows."""
    pairs = F.array(
        *[F.struct(F.lit(n).alias(key), c.alias(value)) for n, c in columns.items()]
    )
    return one_row.select(F.inline(pairs))


def null_cooccurrence(df: DataFrame, given: dict[str, list[str]]) -> DataFrame:
    """(given, column, n_null): nulls of columns where another is null, in one pass."""
    counts = {}
    for first, columns in given.items():
        for column in columns:
            both = F.col(first).isNull() & F.col(column).isNull()
            counts[f"{first}/{column}"] = F.count_if(both)
    one_row = df.agg(*[n.alias(pair) for pair, n in counts.items()])
    rows = to_rows(one_row, {pair: F.col(f"`{pair}`") for pair in counts}, "pair", "n_null")
    return rows.select(
        F.split_part("pair", F.lit("/"), F.lit(1)).alias("given"),
        F.split_part("pair", F.lit("/"), F.lit(2)).alias("column_name"),
        "n_null",
    )


def values_where(df: DataFrame, column: str, given: str, null: bool) -> DataFrame:
    """Distinct values of a column over the rows where ``given`` is (not) null."""
    test = F.col(given).isNull() if null else F.col(given).isNotNull()
    return df.filter(test).select(column).distinct()


def summary(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, sample standard deviation, minimum and maximum, as numbers."""
    value = F.col(column)
    return df.agg(
        F.count(value).alias("count"),
        F.avg(value).alias("mean"),
        F.stddev(value).alias("stddev"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )


def schema_listing(df: DataFrame) -> DataFrame:
    """Name, type and number of set values of each column."""
    types = dict(df.dtypes)
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    rows = to_rows(counts, {c: F.col(c) for c in df.columns}, "column_name", "non_null")
    type_of = F.create_map(*[F.lit(x) for c in df.columns for x in (c, types[c])])
    return rows.select("column_name", type_of[F.col("column_name")].alias("data_type"), "non_null")


def shape(df: DataFrame) -> DataFrame:
    """Number of rows and columns."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
    )


def distinct_count(df: DataFrame, column: str, name: str = "n_distinct") -> DataFrame:
    """Number of distinct set values."""
    return df.agg(F.count_distinct(column).alias(name))


def duplicate_count(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows that repeat an earlier row; the first of each group is not counted."""
    groups = df.groupBy(*(columns or df.columns)).agg(F.count(F.lit(1)).alias("__copies"))
    return groups.agg(F.coalesce(F.sum(F.col("__copies") - 1), F.lit(0)).alias("n_duplicates"))


def preview(df: DataFrame, order: list[str], n: int, columns: list[str] | None = None) -> DataFrame:
    """The first ``n`` rows in a given order (a top-n, so no full sort)."""
    return df.orderBy(*order).limit(n).select(*(columns or df.columns))


def columns_by_rule(df: DataFrame, prefix: str = "", not_suffix: str | None = None) -> list[str]:
    """Column names with a prefix and without a suffix, in table order."""
    return [
        c
        for c in df.columns
        if c.startswith(prefix) and not (not_suffix and c.endswith(not_suffix))
    ]


def columns_except(columns: list[str], *left_out: list[str]) -> list[str]:
    """Difference of name lists that keeps the order of the first."""
    gone = {name for names in left_out for name in names}
    return [c for c in columns if c not in gone]


def columns_from(df: DataFrame, position: int) -> DataFrame:
    """The columns from a position onward."""
    return df.select(*df.columns[position:])
