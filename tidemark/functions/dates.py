"""Date and time functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions._cols import ColumnLike, as_column


def epoch_millis_time(millis: ColumnLike) -> Column:
    """Epoch milliseconds as a timestamp of the session time zone."""
    return F.timestamp_millis(as_column(millis))


def epoch_millis_text(millis: ColumnLike) -> Column:
    """Epoch milliseconds as ``yyyy-MM-dd HH:mm:ss``, cut to whole seconds."""
    return F.date_format(epoch_millis_time(millis), "yyyy-MM-dd HH:mm:ss")


def calendar_parts(
    time: ColumnLike,
    year: str,
    month: str,
    week: str,
    day: str,
    weekday: str,
    hour: str,
) -> dict[str, Column]:
    """Six date parts under the given names; weeks are ISO, Sunday is weekday 1."""
    moment = as_column(time)
    return {
        year: F.year(moment),
        month: F.month(moment),
        week: F.weekofyear(moment),
        day: F.dayofmonth(moment),
        weekday: F.dayofweek(moment),
        hour: F.hour(moment),
    }


def text_date(text: ColumnLike, strict: bool = False) -> Column:
    """ISO date text as a date; bad text gives null, or raises in strict mode."""
    return as_column(text).cast("date") if strict else as_column(text).try_cast("date")
