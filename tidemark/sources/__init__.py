"""Readers, writers and declared schemas."""

from tidemark.sources.files import (
    read_calendar,
    read_categories,
    read_csv,
    read_events,
    read_listings,
    read_messages,
    read_table,
    stored,
    write_csv,
    write_json,
    write_table,
)
from tidemark.sources.schemas import (
    CALENDAR_SCHEMA,
    CATEGORIES_SCHEMA,
    EVENT_SCHEMA,
    LISTING_SCHEMA,
    MESSAGE_SCHEMA,
)
from tidemark.sources.units import Units

__all__ = [
    "CALENDAR_SCHEMA",
    "CATEGORIES_SCHEMA",
    "EVENT_SCHEMA",
    "LISTING_SCHEMA",
    "MESSAGE_SCHEMA",
    "Units",
    "read_calendar",
    "read_categories",
    "read_csv",
    "read_events",
    "read_listings",
    "read_messages",
    "read_table",
    "stored",
    "write_csv",
    "write_json",
    "write_table",
]
