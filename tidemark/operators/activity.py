"""Activity log: cleaning, date parts, churn labels and per-user measures.

Every per-user measure is an aggregate that combines on the map side before the
shuffle, so one very active user costs no more than its distinct values. The
measures can be asked for alone or together (``plans.churn.user_features``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import (
    calendar_parts,
    device_name,
    epoch_millis_text,
    epoch_millis_time,
    paid_flag,
    state_code,
    suffix_name,
)

# The page that means churn, and the pages left out of page counts.
CHURN_PAGE = "Cancellation Confirmation"
CANCEL_PAGES = ["Cancellation Confirmation", "Cancel"]

HOURS = range(24)
MILLIS_PER_SECOND = 1000


def clean_log(log: DataFrame) -> DataFrame:
    """Drop the rows of visitors who never registered."""
    return log.dropna(how="any", subset=["firstName"])


def add_time_text(log: DataFrame) -> DataFrame:
    """Event and registration time as text."""
    return log.withColumns(
        {
            "datetime": epoch_millis_text("ts"),
            "reg_datetime": epoch_millis_text("registration"),
        }
    )


def event_parts() -> dict[str, Column]:
    """Date parts of the event."""
    return calendar_parts(
        epoch_millis_time("ts"),
        year="year",
        month="month",
        week="week_of_year",
        day="day_of_month",
        weekday="day_of_week",
        hour="hour",
    )


def registration_parts() -> dict[str, Column]:
    """Date parts of the registration."""
    return calendar_parts(
        epoch_millis_time("registration"),
        year="reg_year",
        month="reg_month",
        week="reg_woy",
        day="reg_dom",
        weekday="reg_dow",
        hour="reg_hour",
    )


def add_date_parts(log: DataFrame) -> DataFrame:
    """Time text and all date parts."""
    return add_time_text(log).withColumns({**event_parts(), **registration_parts()})


def event_hour() -> Column:
    return F.hour(epoch_millis_time("ts"))


# --- labels -----------------------------------------------------------------


def churn_flag() -> Column:
    """Aggregate: 1 if any row of the group is the churn page, else 0."""
    return F.coalesce(F.max((F.col("page") == CHURN_PAGE).cast("int")), F.lit(0))


def churn_labels(log: DataFrame) -> DataFrame:
    """One row per user: (userId, label), in one pass."""
    return (
        log.filter(F.col("userId").isNotNull())
        .groupBy("userId")
        .agg(churn_flag().alias("label"))
    )


def churn_labels_union(log: DataFrame) -> DataFrame:
    """The same labels put together from the users who left and the rest."""
    users = log.filter(F.col("userId").isNotNull())
    left = users.filter(F.col("page") == CHURN_PAGE).select("userId").distinct()
    stayed = users.select("userId").distinct().join(left, "userId", "left_anti")
    return left.withColumn("label", F.lit(1)).unionByName(stayed.withColumn("label", F.lit(0)))


def add_labels(log: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """The log with the label of each row's user."""
    return log.join(churn_labels(log) if labels is None else labels, on="userId")


def label_balance(labels: DataFrame) -> DataFrame:
    """Number of users per label."""
    return labels.groupBy("label").agg(F.count("userId").alias("num_users"))


def churn_rate(labels: DataFrame) -> DataFrame:
    """Number of users, of churned users, and their share."""
    return labels.agg(
        F.count(F.lit(1)).alias("num_users"),
        F.count_if(F.col("label") == 1).alias("num_churned"),
        F.avg("label").alias("churn_rate"),
    )


# --- aggregates per user ----------------------------------------------------


def length_aggregates() -> dict[str, Column]:
    length = F.col("length")
    return {
        "sum_length": F.sum(length),
        "mean_length": F.avg(length),
        "max_length": F.max(length),
        "min_length": F.min(length),
        "median_length": F.percentile_approx(length, 0.5),
    }


def level_aggregate() -> Column:
    return F.max(paid_flag("level"))


def lifetime_aggregate() -> Column:
    """Days from the first registration stamp to the last event."""
    millis = F.max("ts") - F.min("registration")
    return millis / MILLIS_PER_SECOND / 60 / 60 / 24


def page_aggregates(pages: list[str]) -> dict[str, Column]:
    """Number of events of each page; the cancel pages are left out."""
    return {
        suffix_name(page, "_pagecnt"): F.count_if(F.col("page") == page)
        for page in pages
        if page not in CANCEL_PAGES
    }


def has_other_pages() -> Column:
    """Aggregate: whether any page but the cancel pages was seen."""
    return F.count_if(~F.col("page").isin(CANCEL_PAGES)) > 0


def hour_count_aggregates(hour: Column) -> dict[str, Column]:
    seen = F.col("page").isNotNull()
    return {f"num_pages_hr{h}": F.count_if(seen & (hour == h)) for h in HOURS}


def hour_share_aggregates(hour: Column) -> dict[str, Column]:
    """Share of the user's events that fall in each hour of the day."""
    counts = hour_count_aggregates(hour)
    return {name: F.try_divide(n, F.count("page")) for name, n in counts.items()}


def per_user(log: DataFrame, aggregates: dict[str, Column]) -> DataFrame:
    """(label, userId, measures...) in one aggregation; no join for the label."""
    named = [column.alias(name) for name, column in aggregates.items()]
    return (
        log.filter(F.col("userId").isNotNull())
        .groupBy("userId")
        .agg(churn_flag().alias("label"), *named)
        .select("label", "userId", *aggregates)
    )


def artists_per_user(log: DataFrame) -> DataFrame:
    return per_user(log, {"num_artists": F.count_distinct("artist")})


def length_stats(log: DataFrame) -> DataFrame:
    return per_user(log, length_aggregates())


def levels(log: DataFrame) -> DataFrame:
    return per_user(log, {"is_paid": level_aggregate()})


def song_counts(log: DataFrame) -> DataFrame:
    return per_user(
        log, {"num_songs": F.count("song"), "num_unique_songs": F.count_distinct("song")}
    )


def avg_times_per_song(log: DataFrame, songs_only: bool = False) -> DataFrame:
    """Mean number of plays per song of a user.

    The mean over groups is rows over number of groups, so one distinct count is
    enough. Rows without a song make one more group unless ``songs_only``.
    """
    distinct = F.count_distinct("song")
    if songs_only:
        mean = F.try_divide(F.count("song"), distinct)
    else:
        mean = F.count(F.lit(1)) / (distinct + F.max(F.col("song").isNull().cast("int")))
    return per_user(log, {"avg_times_per_song": mean})


def lifetime_days(log: DataFrame) -> DataFrame:
    return per_user(log, {"lifetime_day": lifetime_aggregate()})


def page_values(log: DataFrame) -> DataFrame:
    """(page) rows: the pages that occur, without those of cancelling."""
    kept = log.filter(F.col("page").isNotNull() & ~F.col("page").isin(CANCEL_PAGES))
    return kept.select("page").distinct()


def page_counts(log: DataFrame) -> DataFrame:
    """(label, userId, page, num_events) rows; needs no list of pages."""
    counts = (
        log.filter(F.col("userId").isNotNull() & ~F.col("page").isin(CANCEL_PAGES))
        .groupBy("userId", "page")
        .agg(F.count(F.lit(1)).alias("num_events"))
    )
    return counts.join(churn_labels(log), "userId").select("label", "userId", "page", "num_events")


def page_pivot(log: DataFrame, pages: list[str]) -> DataFrame:
    """One column per page named with the number of events of the user."""
    kept = [page for page in pages if page not in CANCEL_PAGES]
    names = {page: suffix_name(page, "_pagecnt") for page in kept}
    counts = (
        log.filter(F.col("userId").isNotNull() & ~F.col("page").isin(CANCEL_PAGES))
        .groupBy("userId")
        .pivot("page", kept)
        .count()
        .fillna(0, subset=kept)
        .withColumnsRenamed(names)
    )
    return counts.join(churn_labels(log), "userId").select("label", "userId", *names.values())


def hour_pivot(log: DataFrame) -> DataFrame:
    """One column per hour with the number of events of the user."""
    hours = [str(h) for h in HOURS]
    by_hour = (
        log.filter(F.col("userId").isNotNull())
        .groupBy("userId", event_hour().alias("hour"))
        .agg(F.count("page").alias("num_pages"))
    )
    return (
        by_hour.groupBy("userId")
        .pivot("hour", list(HOURS))
        .agg(F.sum("num_pages"))
        .fillna(0, subset=hours)
        .withColumnsRenamed({h: f"num_pages_hr{h}" for h in hours})
    )


def hour_share(log: DataFrame) -> DataFrame:
    """One column per hour with the share of the user's events."""
    timed = log.withColumn("hour", event_hour())
    return per_user(timed, hour_share_aggregates(F.col("hour")))


def hour_share_by_join(log: DataFrame) -> DataFrame:
    """The same shares as hour pivot over user totals."""
    totals = per_user(log, {"num_pages": F.count("page")})
    counts = hour_pivot(log)
    joined = counts.join(totals, on="userId")
    names = [f"num_pages_hr{h}" for h in HOURS]
    shares = {name: F.try_divide(F.col(name), F.col("num_pages")) for name in names}
    return joined.withColumns(shares).drop("num_pages").select("label", "userId", *names)


def user_attribute(log: DataFrame, value: Column, name: str) -> DataFrame:
    """Distinct (label, userId, value) rows.

    The log is read once: the rows are cut to distinct pairs first, and the
    label of a user is taken from its pairs. ``greatest`` changes no label; it
    makes both uses of the pairs need the same columns, so that Spark computes
    and shuffles them only once.
    """
    pairs = (
        log.filter(F.col("userId").isNotNull())
        .groupBy("userId", value.alias(name))
        .agg(churn_flag().alias("__churned"))
    )
    labels = pairs.groupBy("userId").agg(F.max("__churned").alias("label"))
    label = F.greatest("label", "__churned").alias("label")
    return pairs.join(labels, "userId").select(label, "userId", name)


def user_gender(log: DataFrame) -> DataFrame:
    return user_attribute(log, F.col("gender"), "gender")


def user_state(log: DataFrame) -> DataFrame:
    return user_attribute(log, state_code("location"), "state")


def user_device(log: DataFrame) -> DataFrame:
    return user_attribute(log, device_name("userAgent"), "device")


# --- windows ----------------------------------------------------------------


def active_hours(log: DataFrame) -> DataFrame:
    """Hours of each user ranked by number of events, ties by earlier hour.

    The window runs over at most 24 rows per user.
    """
    counts = (
        log.filter(F.col("userId").isNotNull())
        .groupBy("userId", event_hour().alias("hour"))
        .agg(F.count("page").alias("num_pages"), churn_flag().alias("__churned"))
    )
    user = Window.partitionBy("userId")
    by_activity = user.orderBy(F.desc("num_pages"), "hour")
    return counts.select(
        F.max("__churned").over(user).alias("label"),
        "userId",
        "hour",
        "num_pages",
        F.row_number().over(by_activity).alias("row_number"),
    )


def most_active_hour(log: DataFrame) -> DataFrame:
    """The most active hour of each user."""
    return active_hours(log).filter(F.col("row_number") == 1)
