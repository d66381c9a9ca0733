"""Connected components of a link table, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources import stored


def _state(links: DataFrame) -> tuple:
    digest = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(links.agg(F.count(F.lit(1)), digest).first())


def _large_star(links: DataFrame) -> DataFrame:
    """Each node hands the least of its neighbourhood to its larger neighbours."""
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    joined = both.join(least, "u").filter("v > u")
    return joined.select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Each node hands its least smaller neighbour to the others and itself."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component): the least node that links reach, for every node with a link.

    Alternates the two star steps until every node points straight at the least
    node of its component, which takes a number of rounds logarithmic in the
    length of chains. Links in any direction, repeated or to itself are fine; an
    empty table gives an empty one. Each round is a table in the shared folder,
    so a lost executor repeats one round at most, and only a count and a digest
    come to the driver. A node with many links is a hot join key, which AQE splits.
    """
    u, v = F.greatest(left, right).alias("u"), F.least(left, right).alias("v")
    current = stored(links.select(u, v).filter("u > v").distinct(), "links")
    state = _state(current)
    before = None
    while state[0] and before != state:
        current = stored(_small_star(_large_star(current)), "links")
        before, state = state, _state(current)
    centres = current.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(centres)
