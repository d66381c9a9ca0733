"""Declared schemas, so that no read has to infer one from the data."""

EVENT_SCHEMA = """
    userId string, sessionId bigint, itemInSession bigint, ts bigint, registration bigint,
    page string, level string, artist string, song string, length double,
    firstName string, lastName string, gender string, location string, userAgent string
"""

CALENDAR_SCHEMA = "listing_id bigint, date string, price string, adjusted_price string"

LISTING_SCHEMA = "id bigint, neighbourhood string"

MESSAGE_SCHEMA = "id bigint, message string, original string, genre string"

CATEGORIES_SCHEMA = "id bigint, categories string"
