from __future__ import annotations

LOG = (
    "event_id bigint, userId string, sessionId bigint, itemInSession bigint, ts bigint, "
    "registration bigint, page string, level string, artist string, song string, length double, "
    "firstName string, gender string, location string, userAgent string"
)
HOUR = 3_600_000

_DEFAULTS = {
    "userId": "u",
    "sessionId": 1,
    "ts": 0,
    "registration": 0,
    "page": "Home",
    "level": "free",
    "artist": None,
    "song": None,
    "length": None,
    "firstName": "Ann",
    "gender": "F",
    "location": "Austin, TX",
    "userAgent": "Mozilla/5.0 (iPhone; CPU iPhone OS 7_1)",
}


def make_log(spark, rows: list[dict]):
    """A log from partial rows; ids and item positions follow the list order."""
    full = [
        {**_DEFAULTS, "event_id": i, "itemInSession": i, **row} for i, row in enumerate(rows)
    ]
    names = [part.split()[0] for part in LOG.split(", ")]
    return spark.createDataFrame([[row[n] for n in names] for row in full], LOG)


def rows_of(df, *columns):
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=repr)
