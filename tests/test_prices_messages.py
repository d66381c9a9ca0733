import pytest
from helpers import rows_of
from pyspark.errors import NumberFormatException
from pyspark.sql import functions as F

from tidemark.functions import currency, display_name
from tidemark.operators import messages as ms
from tidemark.operators import prices
from tidemark.sources import read_calendar, read_csv, read_messages, read_table, write_table
from tidemark.sources.files import read_listings

MESSAGE = "id bigint, message string, original string, genre string"
NAMES = ["related", "help"]


def test_currency(spark):
    df = spark.createDataFrame([("$1,234.50",), ("80",), (None,), ("n/a",)], "p string")
    assert [r[0] for r in df.select(currency("p")).collect()] == [1234.5, 80.0, None, None]
    with pytest.raises(NumberFormatException):
        df.select(currency("p", strict=True)).collect()


def test_prices_by_date_and_district(spark):
    days = spark.createDataFrame(
        [(1, "2021-12-01", "$10.00", None), (2, "2021-12-01", "$30.00", None), (9, "2021-12-01", "$5.00", None),
         (1, "2021-12-02", None, None), (3, "bad", "$7.00", None)],
        "listing_id bigint, date string, price string, adjusted_price string",
    )
    places = spark.createDataFrame(
        [(1, "上海 / A District "), (2, "x / A District"), (3, "no separator")],
        "id bigint, neighbourhood string",
    )
    parsed = prices.parse_calendar(days)
    by_date = rows_of(prices.price_by_date(parsed).withColumn("date", F.col("date").cast("string")))
    assert by_date == [("2021-12-01", 15.0), ("2021-12-02", None)]
    by_district = prices.price_by_district_date(parsed, places)
    assert rows_of(by_district, "neighbourhood", "price") == [("A District", 20.0), ("A District", None)]
    flags = prices.district_series(by_district, highlighted=["A District"])
    assert {r.highlighted for r in flags.collect()} == {True}
    assert prices.district_series(by_district, "B").count() == 0


def test_csv_by_header_name_with_quotes_and_line_breaks(spark, tmp_path):
    (tmp_path / "l.csv").write_text('name,neighbourhood,id\n"a ""b""\nc","x / y, z",7\n')
    assert rows_of(read_listings(spark, str(tmp_path / "l.csv"))) == [(7, "x / y, z")]
    (tmp_path / "c.csv").write_text('listing_id,date,available,price,adjusted_price\n1,2021-12-01,t,"$1,000.00",\n')
    assert rows_of(read_calendar(spark, str(tmp_path / "c.csv"))) == [(1, "2021-12-01", "$1,000.00", None)]
    (tmp_path / "m.csv").write_text('id,message,original,genre\n2,"two\nlines",,direct\n')
    assert rows_of(read_messages(spark, str(tmp_path / "m.csv"))) == [(2, "two\nlines", None, "direct")]
    assert read_csv(spark, str(tmp_path / "c.csv")).schema["listing_id"].dataType.simpleString() == "int"


def test_table_replaces_what_is_there(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(5), path)
    write_table(spark.range(2), path)
    assert read_table(spark, path).count() == 2
    for n in (5, 2):
        write_table(spark.range(n).withColumn("part", F.col("id") % 2), "kept", ["part"])
    assert read_table(spark, "kept").count() == 2


def _sides(spark):
    messages = spark.createDataFrame(
        [(2, "a", None, "direct"), (2, "a", None, "direct"), (3, "b", "x", "news"), (None, "n", None, None)],
        MESSAGE,
    )
    categories = spark.createDataFrame(
        [(2, "related-2;help-0"), (2, "related-2;help-0"), (2, "related-1;help-0"), (3, "help-1;related-0"), (None, "related-1;help-1")],
        "id bigint, categories string",
    )
    return messages, categories


def test_cleaning(spark):
    messages, categories = _sides(spark)
    merged = ms.merge_messages(messages, categories)
    assert merged.count() == 7
    assert ms.merge_messages(messages, categories, null_keys=True).count() == 8
    # id 2 stays 2; the rows that become equal by 2 -> 1 both stay.
    want = [(2, "a", None, "direct", 1.0, 0.0)] * 2 + [(3, "b", "x", "news", 0.0, 1.0)]
    assert rows_of(ms.clean_merged(merged, NAMES)) == want
    assert rows_of(ms.clean_messages(messages, categories, NAMES)) == want


def test_names_are_keys(spark):
    _, categories = _sides(spark)
    found = rows_of(ms.category_names(categories.filter("id = 2")), "position", "name")
    assert found == list(enumerate(NAMES))
    assert rows_of(ms.name_mismatches(categories, NAMES)) == [(3, "help;related")]
    long = rows_of(ms.categories_long(categories.filter("id = 3")))
    assert long == [(3, "help", 1.0), (3, "related", 0.0)]
    wide = ms.expand_categories(categories.filter("id = 3"), [*NAMES, "absent"])
    assert rows_of(wide) == [(3, 0.0, 1.0, None)]
    twice = spark.createDataFrame([(1, "a-1;a-0")], "id bigint, categories string")
    with pytest.raises(Exception, match="DUPLICATED_MAP_KEY"):
        ms.expand_categories(twice, ["a"]).collect()


def test_counts(spark):
    messages, categories = _sides(spark)
    cleaned = ms.clean_messages(messages, categories, NAMES)
    assert rows_of(ms.genre_counts(cleaned)) == [("direct", 2), ("news", 1)]
    assert rows_of(ms.category_totals(cleaned, NAMES)) == [("help", 1.0), ("related", 2.0)]
    labels = ms.assigned_labels(cleaned.filter("id = 3"), NAMES)
    assert rows_of(labels) == [(3, "Help", True), (3, "Related", False)]
    assert spark.range(1).select(display_name(F.lit("medical_help"))).first()[0] == "Medical Help"
