"""Row numbers whose groups may be large."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources import stored

# Where Spark's increasing ids keep the number of the partition.
_PART_BITS = 33


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Add ``name``: 0, 1, 2, ... in the given order over all rows, without one task for them.

    Rows are range-sorted and stored with their part and their place in it. The sizes
    of the parts before, one number per part, are added on reading. The order should
    be total; equal rows are numbered as they come.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stored(ranged.withColumn("__place", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("__place", _PART_BITS).cast("int")
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    found = {row.part: row.n for row in sizes.collect()}
    width = max(found, default=0) + 1
    before = accumulate((found.get(p, 0) for p in range(width - 1)), initial=0)
    offset = F.get(F.array(*[F.lit(n).cast("bigint") for n in before]), part)
    inside = F.col("__place").bitwiseAND(F.lit((1 << _PART_BITS) - 1))
    return placed.withColumn(name, offset + inside).drop("__place")


def row_number_by_bucket(
    df: DataFrame,
    keys: list[str],
    bucket: str,
    order: list[str],
    name: str,
) -> DataFrame:
    """``row_number`` over (keys, order) without one task per key.

    ``bucket`` must not decrease along ``order``. Rows are numbered inside
    (keys, bucket), and the number of rows in earlier buckets is added, so a hot
    key is spread over as many tasks as it has buckets.
    """
    cell = [*keys, bucket]
    earlier = (
        Window.partitionBy(*keys)
        .orderBy(bucket)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        df.groupBy(*cell)
        .agg(F.count(F.lit(1)).alias("__rows"))
        .select(*cell, F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__before"))
    )
    inside = F.row_number().over(Window.partitionBy(*cell).orderBy(*order))
    return (
        df.withColumn("__inside", inside)
        .join(offsets, on=cell)
        .withColumn(name, F.col("__inside") + F.col("__before"))
        .drop("__inside", "__before")
    )
