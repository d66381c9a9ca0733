"""Exploration tables: what the charts of an analysis show, as small DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators import activity


def with_share(counts: DataFrame, count: str, within: str, name: str = "share") -> DataFrame:
    """Share of each row in the total of its group; the input is already aggregated."""
    total = F.sum(count).over(Window.partitionBy(within))
    return counts.withColumn(name, F.col(count) / total)


def count_by_label(users: DataFrame, column: str, name: str = "num_users") -> DataFrame:
    """Users per (label, value).

    The input has one row per user and value, so counting rows counts distinct
    users without a further shuffle.
    """
    return users.groupBy("label", column).agg(F.count(F.lit(1)).alias(name))


def gender_by_label(log: DataFrame) -> DataFrame:
    counts = count_by_label(activity.user_gender(log), "gender")
    return with_share(counts, "num_users", "gender").orderBy("label", "gender")


def level_by_label(log: DataFrame) -> DataFrame:
    """Users who ever paid, and others, by label."""
    counts = count_by_label(activity.levels(log), "is_paid")
    return with_share(counts, "num_users", "is_paid").orderBy("label", "is_paid")


def state_by_label(log: DataFrame) -> DataFrame:
    return count_by_label(activity.user_state(log), "state")


def device_by_label(log: DataFrame) -> DataFrame:
    counts = count_by_label(activity.user_device(log), "device")
    return with_share(counts, "num_users", "device").orderBy("label", "device")


def registration_counts(log: DataFrame) -> DataFrame:
    """Users by label and each part of their registration date, in long form."""
    parts = activity.registration_parts()
    stamped = activity.user_attribute(log, F.col("registration"), "registration")
    users = stamped.withColumns(parts).select("label", "userId", *parts).distinct()
    # Every row unpivots into six fixed cells that combine before the shuffle.
    return (
        users.unpivot(["label"], list(parts), "part", "value")
        .groupBy("label", "part", "value")
        .agg(F.count(F.lit(1)).alias("num_users"))
    )


def hour_label_crosstab(log: DataFrame) -> DataFrame:
    """For each most active hour, the share of users with each label."""
    users = activity.most_active_hour(log)
    counts = users.groupBy("hour").pivot("label", [0, 1]).count().fillna(0, subset=["0", "1"])
    total = F.col("0") + F.col("1")
    return counts.select(
        "hour", (F.col("0") / total).alias("stayed"), (F.col("1") / total).alias("churned")
    )


def churn_by_hour(log: DataFrame) -> DataFrame:
    """Users who churned by hour of day."""
    return (
        log.filter(F.col("page") == activity.CHURN_PAGE)
        .groupBy(activity.event_hour().alias("hour"))
        .agg(F.count_distinct("userId").alias("num_users"))
        .orderBy("hour")
    )


def sessions_per_user(log: DataFrame) -> DataFrame:
    """Distinct sessions and distinct item positions of each user."""
    return log.groupBy("userId").agg(
        F.count_distinct("sessionId").alias("num_sessions"),
        F.count_distinct("itemInSession").alias("num_items"),
    )


def sessions_of_user(log: DataFrame, user: str) -> DataFrame:
    """Distinct sessions and distinct item positions of one user."""
    return log.filter(F.col("userId") == user).agg(
        F.count_distinct("sessionId").alias("num_sessions"),
        F.count_distinct("itemInSession").alias("num_items"),
    )


def events_of_user(log: DataFrame, user: str, n: int = 100) -> DataFrame:
    """The first ``n`` events of one user."""
    return (
        log.filter(F.col("userId") == user)
        .orderBy("ts", "sessionId", "itemInSession")
        .limit(n)
        .select(
            "page",
            activity.epoch_millis_text("ts").alias("datetime"),
            "sessionId",
            "itemInSession",
        )
    )
