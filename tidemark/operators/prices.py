"""Price calendar: parsing, and mean price by date and by district."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import currency, second_part, text_date

# The districts drawn in another colour.
HIGHLIGHTED = ["Changning District", "Huangpu District", "Jing'an District", "Xuhui District"]


def parse_calendar(calendar: DataFrame, strict: bool = False) -> DataFrame:
    """Date and price text as dates and numbers."""
    return calendar.withColumns(
        {
            "date": text_date("date", strict),
            "price": currency("price", strict),
            "adjusted_price": currency("adjusted_price", strict),
        }
    )


def sorted_calendar(parsed: DataFrame) -> DataFrame:
    """By listing and date; a range-partitioned sort."""
    return parsed.orderBy("listing_id", "date")


def price_by_date(parsed: DataFrame) -> DataFrame:
    """Mean price per date; rows without a date are left out."""
    return (
        parsed.filter(F.col("date").isNotNull())
        .groupBy("date")
        .agg(F.avg("price").alias("price"))
    )


def with_district(parsed: DataFrame, listings: DataFrame) -> DataFrame:
    """Each priced day with the district of its listing; null without one.

    The side of the listings is broadcast by AQE only while it is small. Else a
    hot listing is split, since the calendar is the outer side.
    """
    districts = listings.select("id", second_part("neighbourhood").alias("neighbourhood"))
    days = parsed.select("listing_id", "date", "price")
    return days.join(districts, days.listing_id == districts.id, "left").drop("id")


def price_by_district_date(parsed: DataFrame, listings: DataFrame) -> DataFrame:
    """Mean price per district and date; rows without either are left out."""
    return (
        with_district(parsed, listings)
        .filter(F.col("neighbourhood").isNotNull() & F.col("date").isNotNull())
        .groupBy("neighbourhood", "date")
        .agg(F.avg("price").alias("price"))
    )


def districts(by_district: DataFrame) -> DataFrame:
    """The districts that occur."""
    return by_district.select("neighbourhood").distinct()


def district_series(
    by_district: DataFrame,
    district: str | None = None,
    highlighted: list[str] | None = None,
) -> DataFrame:
    """The series of one district or of all, with a flag for highlighted ones."""
    chosen = HIGHLIGHTED if highlighted is None else highlighted
    series = by_district if district is None else by_district.filter(
        F.col("neighbourhood") == district
    )
    return series.withColumn("highlighted", F.col("neighbourhood").isin(chosen))
