"""Stable train/test splits and frequency indexes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ranking import numbered

_HEX_DIGITS = 8
_STEP = 3


def key_hash(key: str, seed: int) -> Column:
    """Hex digest of seed and key; the same in every run, order and partitioning."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def with_side(df: DataFrame, key: str, train: float = 0.8, seed: int = 2022) -> DataFrame:
    """Add ``side``: train or test by the hash of the key.

    All rows of a key fall on one side; the size is right up to chance. No
    shuffle, and a lost task gives the same rows again.
    """
    bound = format(int(train * 16**_HEX_DIGITS), f"0{_HEX_DIGITS}x")
    low = F.substring(key_hash(key, seed), 1, _HEX_DIGITS) < bound
    return df.withColumn("side", F.when(low, "train").otherwise("test"))


def train_and_test(
    df: DataFrame, key: str, train: float = 0.8, seed: int = 2022
) -> tuple[DataFrame, DataFrame]:
    sided = with_side(df, key, train, seed)
    return (
        sided.filter(F.col("side") == "train").drop("side"),
        sided.filter(F.col("side") == "test").drop("side"),
    )


def with_exact_side(df: DataFrame, key: str, train: float = 0.8, seed: int = 2022) -> DataFrame:
    """Add ``side`` so that n - ceil(n * (1 - train)) rows, or as many as fit, are for training.

    Rows are taken in hash order of the key; all rows of a key are on one side, so
    with unique keys the number is met exactly. The first hash beyond the quota is
    found by counts per prefix, ``_STEP`` digits more in each of three rounds, and is
    one value of the plan: the rows themselves are neither joined nor shuffled.
    """
    hashed = df.select(key_hash(key, seed).alias("__hash"))
    total = hashed.agg(F.count(F.lit(1))).scalar()
    quota = total - F.ceil(F.round(total * (1 - train), 9))
    before, inside = F.lit(0).cast("bigint"), hashed
    for digits in (_STEP, 2 * _STEP, 32):
        prefix = F.substring("__hash", 1, digits)
        # At most 16^_STEP rows in the first two rounds, and in the last only the
        # hashes that share the prefix.
        order = Window.orderBy("__prefix").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        counts = inside.groupBy(prefix.alias("__prefix")).agg(F.count(F.lit(1)).alias("__size"))
        upto = counts.select("__prefix", "__size", (before + F.sum("__size").over(order)).alias("__upto"))
        first = upto.filter(F.col("__upto") > quota).agg(
            F.min(F.struct("__prefix", (F.col("__upto") - F.col("__size")).alias("__before"))).alias("__first")
        )
        found = first.scalar()
        before, inside = found.getField("__before"), hashed.filter(prefix == found.getField("__prefix"))
    beyond = found.getField("__prefix")
    side = F.when(F.coalesce(key_hash(key, seed) >= beyond, F.lit(False)), "test").otherwise("train")
    return df.withColumn("side", side)


def frequency_index(df: DataFrame, column: str) -> DataFrame:
    """(value, count, index): 0 for the most frequent value, ties by name, for any number of values."""
    counts = (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("count"))
    )
    ranked = numbered(counts, [F.desc("count"), F.asc(column)], "index")
    return ranked.withColumn("index", F.col("index").cast("double"))
