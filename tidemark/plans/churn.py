"""Churn job: activity log to one feature row per user."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import device_name, state_code
from tidemark.operators import activity
from tidemark.operators.quality import columns_except

ATTRIBUTES = ["gender", "state", "device"]
SONG_MEASURES = ["sum_length", "mean_length", "max_length", "min_length", "median_length"]


def feature_columns(pages: list[str]) -> list[str]:
    """Columns of the feature table after label and userId, in order."""
    return [
        "num_artists",
        *SONG_MEASURES,
        "gender",
        "is_paid",
        "state",
        *activity.page_aggregates(pages),
        "lifetime_day",
        "num_songs",
        "num_unique_songs",
        "avg_times_per_song",
        *(f"num_pages_hr{h}" for h in activity.HOURS),
        "device",
    ]


def _plain_measures(log: DataFrame, pages: list[str]) -> DataFrame:
    """Measures with fixed-width state: one hash aggregation in generated code."""
    lengths = activity.length_aggregates()
    del lengths["median_length"]
    aggregates = {
        **lengths,
        "is_paid": activity.level_aggregate(),
        **activity.page_aggregates(pages),
        "lifetime_day": activity.lifetime_aggregate(),
        "num_songs": F.count("song"),
        **activity.hour_share_aggregates(F.col("hour")),
        "__other_pages": activity.has_other_pages(),
    }
    timed = log.withColumn("hour", activity.event_hour())
    # A user who only ever cancelled has no page counts and so no feature row.
    return activity.per_user(timed, aggregates).filter("__other_pages").drop("__other_pages")


def _order(log: DataFrame) -> list[str]:
    """The columns that say which row of a user is the latest."""
    return ["ts", "event_id"] if "event_id" in log.columns else ["ts", "sessionId", "itemInSession"]


def _attributes() -> dict[str, Column]:
    return {
        "gender": F.col("gender"),
        "state": state_code("location"),
        "device": device_name("userAgent"),
    }


def latest_attributes(log: DataFrame, order: list[str] | None = None) -> DataFrame:
    """(userId, gender, state, device) of the users of the feature table, without its measures."""
    values = [c.alias(n) for n, c in _attributes().items()]
    latest = F.max(F.struct(*(order or _order(log)), *values)).alias("__latest")
    users = log.filter(F.col("userId").isNotNull()).groupBy("userId")
    found = users.agg(latest, activity.has_other_pages().alias("__other_pages"))
    return found.filter("__other_pages").select("userId", *[f"__latest.{n}" for n in _attributes()])


def _median_and_latest(log: DataFrame, order: list[str]) -> DataFrame:
    """The median sketch and the latest attributes, whose state has no fixed width."""
    attributes = _attributes()
    latest = F.max(F.struct(*order, *[c.alias(n) for n, c in attributes.items()]))
    return (
        log.groupBy("userId")
        .agg(
            activity.length_aggregates()["median_length"].alias("median_length"),
            latest.alias("__latest"),
        )
        .select("userId", "median_length", *[f"__latest.{name}" for name in attributes])
    )


def _distinct_measures(log: DataFrame) -> DataFrame:
    """Distinct artists and songs over rows already cut to distinct triples."""
    plays = log.groupBy("userId", "artist", "song").agg(F.count(F.lit(1)).alias("__rows"))
    songs = F.count_distinct("song")
    groups = songs + F.max(F.col("song").isNull().cast("int"))
    return plays.groupBy("userId").agg(
        F.count_distinct("artist").alias("num_artists"),
        songs.alias("num_unique_songs"),
        (F.sum("__rows") / groups).alias("avg_times_per_song"),
    )


def user_features(
    log: DataFrame,
    pages: list[str],
    grain: str = "user",
    order: list[str] | None = None,
) -> DataFrame:
    """The feature table over a cleaned log.

    ``grain="user"`` gives one row per user with the latest gender, state and
    device. ``grain="reference"`` gives one row per combination of the values a
    user ever had. ``pages`` names the page columns (``activity.page_values`` lists
    those that occur). ``order`` breaks ties of the latest row.

    Three aggregations instead of one, each on its own columns: fixed-width
    measures, variable-width state, distinct counts. They are hashed by user and
    join without a further exchange. A single aggregation would copy every row
    for each distinct count and carry the sketch through each copy.
    """
    order = order or _order(log)
    users = log.filter(F.col("userId").isNotNull())
    features = (
        _plain_measures(users, pages)
        .join(_median_and_latest(users, order), "userId")
        .join(_distinct_measures(users), "userId")
    )
    if grain == "reference":
        features = features.drop(*ATTRIBUTES)
        for attribute in (activity.user_gender, activity.user_state, activity.user_device):
            features = features.join(attribute(users).drop("label"), "userId")
    elif grain != "user":
        raise ValueError(f"unknown grain {grain!r}")
    return features.select("label", "userId", *feature_columns(pages))


def fill_song_measures(features: DataFrame) -> DataFrame:
    """0 for the song measures of users without songs, and a flag for the others."""
    return features.withColumn(
        "has_songs", (F.col("num_songs") > 0).cast("int")
    ).fillna(0, subset=SONG_MEASURES)


def charted_measures(pages: list[str]) -> list[str]:
    """The measures whose distribution is compared by label."""
    names = columns_except(feature_columns(pages), ATTRIBUTES, ["is_paid"])
    return [name for name in names if not name.startswith("num_pages_hr")]
