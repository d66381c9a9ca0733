"""Views with the shapes of the activity log, the price files and the message
files over the Parquet tables of one folder (see FIXTURES.md, part B)."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.ranking import row_number_by_bucket

_DAY_MILLIS = 86_400_000


@lru_cache(maxsize=64)
def _schema(path: str) -> StructType:
    return SparkSession.active().read.parquet(path).schema


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table; its schema is looked up once per process, not on every read."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    return spark.read.schema(_schema(path)).parquet(path)


def _choose(value: Column, options: dict, otherwise: str) -> Column:
    """A CASE over one value."""
    chosen = None
    for key, text in options.items():
        start = F if chosen is None else chosen
        chosen = start.when(value == key, text)
    return chosen.otherwise(otherwise)


def activity_log(
    spark: SparkSession,
    sf_dir: str,
    registration: bool = True,
    items: bool = False,
) -> DataFrame:
    """Activity log over ``events`` and ``customer``.

    ``registration`` and ``items`` (the position inside a session) each need
    work of their own: an aggregate over all events, and a numbering. Ask for
    them only where they are read.
    """
    events = table(spark, sf_dir, "events")
    # Users grow with the log, and a broadcast is decided by the size of their compressed
    # files: many times that would go through the driver, once per read of the log.
    users = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey").hint("merge")
    if registration:
        firsts = events.groupBy(F.col("user_id").alias("first_user")).agg(
            F.min("ts").alias("first_ts")
        )
        users = users.join(firsts, users.c_custkey == firsts.first_user).drop("first_user")
    log = events.join(users.hint("merge"), events.user_id == users.c_custkey)
    day = F.dayofmonth("ts").cast("bigint")
    user = F.col("user_id")
    if items:
        log = row_number_by_bucket(
            log.withColumn("day_no", day).withColumn(
                "second_no", F.unix_seconds(F.col("ts").cast("timestamp"))
            ),
            keys=["user_id", "day_no"],
            bucket="second_no",
            order=["ts", "event_id"],
            name="item_no",
        )

    named = ~((F.col("event_type") == "signup") & (F.col("value") < 2))
    viewed = F.col("event_type") == "view"
    k = F.regexp_extract("props", "([0-9]+)", 1)
    page = (
        F.when((F.col("event_type") == "error") & (F.col("value") > 150), "Cancellation Confirmation")
        .when((F.col("event_type") == "error") & (F.col("value") > 120), "Cancel")
        .when(viewed, "NextSong")
        .when(F.col("event_type") == "click", "Thumbs Up")
        .when(F.col("event_type") == "purchase", "Upgrade")
        .when(F.col("event_type") == "signup", "Home")
        .otherwise("Error")
    )
    # State and device change within a user, so that the latest differs from the rest.
    moved = F.when(F.col("event_id") % 5 == 0, 1).otherwise(0)
    switched = F.when(F.col("event_id") % 3 == 0, 1).otherwise(0)
    state = _choose((F.col("c_nationkey") + moved) % 4, {0: "CA", 1: "TX", 2: "PA"}, "WI")
    agent = _choose(
        (user + switched) % 5,
        {
            0: "Mozilla/5.0 (Windows NT 6.1; WOW64)",
            1: "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_9_4)",
            2: "Mozilla/5.0 (X11; Linux x86_64)",
            3: "Mozilla/5.0 (iPhone; CPU iPhone OS 7_1)",
        },
        "Mozilla/5.0 (iPad; CPU OS 7_1)",
    )
    paid = (F.col("event_type") == "purchase") & (F.col("value") > 150)
    columns = {
        "event_id": F.col("event_id"),
        "userId": user.cast("string"),
        "sessionId": user * 100 + day,
        "ts": F.unix_millis(F.col("ts").cast("timestamp")),
        "page": page,
        "level": F.when(paid, "paid").otherwise("free"),
        "artist": F.when(viewed, F.concat(F.lit("artist"), F.substring(k, 1, 1))),
        "song": F.when(viewed, F.concat(F.lit("song"), k)),
        "length": F.when(viewed, F.col("value")),
        "firstName": F.when(named, F.col("c_name")),
        "lastName": F.when(named, F.concat(F.lit("L"), user.cast("string"))),
        "gender": F.when(named, F.when(user % 2 == 0, "M").otherwise("F")),
        "location": F.when(
            named,
            F.concat(F.lit("City"), F.col("c_nationkey").cast("string"), F.lit(", "), state),
        ),
        "userAgent": F.when(named, agent),
    }
    if registration:
        first = F.unix_millis(F.col("first_ts").cast("timestamp"))
        columns["registration"] = F.when(named, first - (user % 90) * _DAY_MILLIS)
    if items:
        columns["itemInSession"] = F.col("item_no") - 1
    return log.select(*[column.alias(name) for name, column in columns.items()])


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    money = F.concat(F.lit("$"), F.format_number("l_extendedprice", 2))
    lines = table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_shipdate", "l_linenumber", "l_extendedprice"
    )
    return lines.select(
        F.col("l_partkey").alias("listing_id"),
        F.col("l_shipdate").cast("date").cast("string").alias("date"),
        F.when(F.col("l_linenumber") != 7, money).alias("price"),
        money.alias("adjusted_price"),
    )


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per part; promoted parts name no district, so that some splits miss."""
    district = F.concat("p_type", F.lit(" / "), "p_brand", F.lit(" District"))
    place = F.when(F.col("p_type") == "PROMO", F.col("p_brand")).otherwise(district)
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), place.alias("neighbourhood")
    )


def _message_columns(text: Column) -> list[Column]:
    return [
        F.col("doc_id").alias("id"),
        text.alias("message"),
        F.lit(None).cast("string").alias("original"),
        F.col("lang").alias("genre"),
    ]


def messages(spark: SparkSession, sf_dir: str, with_urls: bool = False) -> DataFrame:
    """Documents as messages; ``with_urls`` puts the page address before the text.

    A tenth of those also ends in words the splitter divides.
    """
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    text = F.col("text")
    if with_urls:
        pages = table(spark, sf_dir, "pages").select("page_id", "url")
        documents = documents.join(pages, documents.doc_id == pages.page_id, "left")
        more = F.when(F.col("doc_id") % 10 == 0, " we wanna go wanna").otherwise("")
        text = F.concat(F.concat_ws(" ", "url", "text"), more)
    return documents.select(*_message_columns(text))


def message_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same messages as a stream over ``documents``, one file or a folder of parts.

    The pattern stands for a folder to Spark's stream, whichever of the two it finds.
    """
    schema = table(spark, sf_dir, "documents").schema
    documents = spark.readStream.schema(schema).parquet(f"{sf_dir}/documents.parquet*")
    return documents.select(*_message_columns(F.col("text")))


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed label text; ``related`` reaches 2, and every seventh row has another order."""
    values = {
        "related": F.col("quality") + F.col("toxic"),
        "quality": F.col("quality"),
        "toxic": F.col("toxic"),
    }
    packed = {n: F.concat(F.lit(f"{n}-"), v.cast("string")) for n, v in values.items()}
    usual = F.concat_ws(";", *packed.values())
    other = F.concat_ws(";", packed["quality"], packed["related"], packed["toxic"])
    return table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("id"),
        F.when(F.col("doc_id") % 7 == 0, other).otherwise(usual).alias("categories"),
    )


CATEGORY_NAMES = ["related", "quality", "toxic"]

PAGES = [
    "Cancel",
    "Cancellation Confirmation",
    "Error",
    "Home",
    "NextSong",
    "Thumbs Up",
    "Upgrade",
]
