"""Short string functions of the activity log, the listings and the labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions._cols import ColumnLike, as_column

_BLANKS = " \t\n\r\f\v"


def state_code(location: ColumnLike) -> Column:
    """The last two characters of a location."""
    return F.right(as_column(location), F.lit(2))


def device_name(user_agent: ColumnLike) -> Column:
    """First word inside the first bracket of a user agent; null without a bracket."""
    inside = F.get(F.split(as_column(user_agent), r"\("), F.lit(1))
    return F.split_part(F.translate(inside, ";", " "), F.lit(" "), F.lit(1))


def paid_flag(level: ColumnLike) -> Column:
    """1 for the paid level, 0 for all else and for null."""
    return F.coalesce((as_column(level) == "paid").cast("int"), F.lit(0))


def second_part(text: ColumnLike, separator: str = "/") -> Column:
    """The trimmed text between the first and second separator; null without one."""
    part = F.get(F.split(as_column(text), f"\\Q{separator}\\E"), F.lit(1))
    return F.btrim(part, F.lit(_BLANKS))


def display_name(name: ColumnLike) -> Column:
    """``medical_help`` as ``Medical Help``."""
    return F.initcap(F.replace(as_column(name), F.lit("_"), F.lit(" ")))


def suffix_name(value: str, suffix: str) -> str:
    """Column name for a pivot value: lower case, no blanks, with a suffix."""
    return value.lower().replace(" ", "") + suffix
