"""Write and read back in each supported format."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.session import scratch_path
from tidemark.sources import (
    EVENT_SCHEMA,
    read_calendar,
    read_events,
    read_messages,
    write_csv,
    write_json,
)


def json_events(log: DataFrame) -> DataFrame:
    spark = log.sparkSession
    path = scratch_path(spark, "events-json")
    write_json(log, path)
    return read_events(spark, path, EVENT_SCHEMA)


def csv_calendar(calendar: DataFrame) -> DataFrame:
    path = scratch_path(calendar.sparkSession, "calendar-csv")
    write_csv(calendar, path)
    return read_calendar(calendar.sparkSession, path)


def csv_messages(messages: DataFrame) -> DataFrame:
    path = scratch_path(messages.sparkSession, "messages-csv")
    write_csv(messages, path)
    return read_messages(messages.sparkSession, path)
