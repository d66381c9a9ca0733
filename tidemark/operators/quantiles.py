"""Exact quantiles of few groups with many rows each."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources import stored

# The ladder of nested quantiles drawn by a letter-value plot.
LADDER = [1 / 32, 1 / 16, 1 / 8, 1 / 4, 1 / 2, 3 / 4, 7 / 8, 15 / 16, 31 / 32]


def exact_quantiles(
    df: DataFrame,
    keys: list[str],
    value: str,
    probabilities: list[float] | None = None,
    buckets: int = 128,
    name: str = "quantile",
) -> DataFrame:
    """Interpolated quantiles per group: (keys..., probability, ``name``).

    The built-in exact percentile holds all distinct values of a group in one
    task. Here equal values are merged and counted first, and the counts stored,
    since they are read three times. Each group is then cut into value buckets
    along approximate quantiles of its distinct values; ranks are found per
    bucket, so no task sees more than about 1/``buckets`` of them. The cut points
    (one bounded row per group) are stored, which keeps them the same on a task
    retry; they steer only the balance, not the result. Nulls are skipped.
    """
    probabilities = LADDER if probabilities is None else probabilities
    rows = df.filter(F.col(value).isNotNull()).select(
        *keys, F.col(value).cast("double").alias("__value")
    )
    counts = stored(
        rows.groupBy(*keys, "__value").agg(F.count(F.lit(1)).alias("__copies")), "value-counts"
    )

    steps = [i / buckets for i in range(1, buckets)]
    cuts_of_group = F.percentile_approx("__value", steps).alias("__cuts")
    # Stored, so that a retried task sees the same cuts; joined like any table of its size.
    cuts = stored(counts.groupBy(*keys).agg(cuts_of_group), "value-cuts")

    below = F.size(F.filter(F.array_distinct("__cuts"), lambda cut: cut < F.col("__value")))
    matches = [F.col(f"v.{k}").eqNullSafe(F.col(f"c.{k}")) for k in keys]
    bucketed = (
        counts.alias("v")
        .join(cuts.alias("c"), matches)
        .select(*[F.col(f"v.{k}") for k in keys], "__value", "__copies", below.alias("__bucket"))
    )

    # Per bucket: rows before it, and the wanted ranks that fall inside.
    group = Window.partitionBy(*keys)
    earlier = group.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        bucketed.groupBy(*keys, "__bucket")
        .agg(F.sum("__copies").alias("__size"))
        .withColumn("__before", F.coalesce(F.sum("__size").over(earlier), F.lit(0)))
        .withColumn("__n", F.sum("__size").over(group))
    )
    position = F.col("probability") * (F.col("__n") - 1)
    wanted = (
        totals.withColumn("probability", F.explode(F.array(*[F.lit(p) for p in probabilities])))
        .withColumn("__part", position - F.floor(position))
        .withColumn("__rank", F.explode(F.array(F.floor(position), F.ceil(position))))
        .withColumn("__inside", F.col("__rank") - F.col("__before"))
        .filter((F.col("__inside") >= 0) & (F.col("__inside") < F.col("__size")))
        .select(
            *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
            F.col("__bucket").alias("__b"),
            "probability",
            "__part",
            F.col("__inside").alias("__target"),
        )
    )

    upto = (
        Window.partitionBy(*keys, "__bucket")
        .orderBy("__value")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ranked = bucketed.withColumn("__last", F.sum("__copies").over(upto))
    same = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    hits = ranked.join(wanted, [*same, F.col("__bucket") == F.col("__b")]).filter(
        (F.col("__target") < F.col("__last"))
        & (F.col("__target") >= F.col("__last") - F.col("__copies"))
    )
    low, high = F.min("__value"), F.max("__value")
    return hits.groupBy(*keys, "probability").agg(
        (low + (high - low) * F.first("__part")).alias(name)
    )


def measure_quantiles_by_label(
    users: DataFrame,
    measures: list[str],
    probabilities: list[float] | None = None,
) -> DataFrame:
    """(label, measure, probability, quantile) over a table with one row per user."""
    typed = users.select("label", *[F.col(m).cast("double").alias(m) for m in measures])
    rows = typed.unpivot(["label"], measures, "measure", "value")
    return exact_quantiles(rows, ["label", "measure"], "value", probabilities)
