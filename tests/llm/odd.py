"""Rows that operators must not stumble over."""

from __future__ import annotations

LONG = "the long one " * 20_000 + "end\n" + "x" * 5_000

DOCS = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    # Columns with names that operators use themselves.
    "row string, score double, size bigint, text_key string, line string, k int"
)
_REST = ("r", 0.5, 7, "t", "l", 1)
ROWS = [
    (1, "One two three four.\nShared footer line here.", "en", "a", 44, *_REST),
    (2, "Five six seven eight nine.\nShared footer line here.", "en", "b", 50, *_REST),
    (3, "Ten eleven twelve.\nShared footer line here.\nShared footer line here.", "en", "c", 60, *_REST),
    (4, None, "en", "a", None, *_REST),
    (5, "", None, None, 0, *_REST),
    (6, LONG, "en", "b", len(LONG), *_REST),
    (7, " \t\n \n", "en", "a", 5, *_REST),
    (None, "No id, some words in here.", "de", "c", 26, *_REST),
    (None, None, None, None, None, None, None, None, None, None, None),
    (8, "Same row twice.", "fr", "a", 15, *_REST),
    (8, "Same row twice.", "fr", "a", 15, *_REST),
    (8, "Same id, other text é 日本.", "fr", "b", 26, *_REST),
    (9, "don't we'll it's <|endoftext|> \x00 end", "en", "c", 37, *_REST),
]


def docs(spark, rows=ROWS):
    return spark.createDataFrame(rows, DOCS)


def none(spark):
    return spark.createDataFrame([], DOCS)


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id bigint, quality int, toxic int")
