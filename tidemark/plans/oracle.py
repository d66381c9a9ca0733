"""Independent SQL for the registered queries, for DuckDB on the same tables."""

from __future__ import annotations

from tidemark.functions.text import STOP_WORDS
from tidemark.sources.driver_tables import CATEGORY_NAMES, PAGES

ORACLE: dict[str, str] = {}

_BASE_LOG = """
base AS (
  SELECT e.*, c.c_name, c.c_nationkey,
         (e.event_type = 'signup' AND e.value < 2) AS anon,
         MIN(e.ts) OVER (PARTITION BY e.user_id) AS first_ts,
         CAST(extract(DAY FROM e.ts) AS BIGINT) AS day_no,
         regexp_extract(e.props, '([0-9]+)', 1) AS k
  FROM events e JOIN customer c ON e.user_id = c.c_custkey),
activity_log AS (
  SELECT event_id,
    CAST(user_id AS VARCHAR) AS userId,
    user_id * 100 + day_no AS sessionId,
    CAST(ROW_NUMBER() OVER (PARTITION BY user_id, day_no ORDER BY ts, event_id) - 1 AS BIGINT)
      AS itemInSession,
    (epoch_us(ts) // 1000) AS ts,
    CASE WHEN NOT anon THEN (epoch_us(first_ts) // 1000) - (user_id % 90) * 86400000 END
      AS registration,
    CASE WHEN event_type = 'error' AND value > 150 THEN 'Cancellation Confirmation'
         WHEN event_type = 'error' AND value > 120 THEN 'Cancel'
         WHEN event_type = 'view' THEN 'NextSong'
         WHEN event_type = 'click' THEN 'Thumbs Up'
         WHEN event_type = 'purchase' THEN 'Upgrade'
         WHEN event_type = 'signup' THEN 'Home'
         ELSE 'Error' END AS page,
    CASE WHEN event_type = 'purchase' AND value > 150 THEN 'paid' ELSE 'free' END AS level,
    CASE WHEN event_type = 'view' THEN concat('artist', substr(k, 1, 1)) END AS artist,
    CASE WHEN event_type = 'view' THEN concat('song', k) END AS song,
    CASE WHEN event_type = 'view' THEN value END AS length,
    CASE WHEN NOT anon THEN c_name END AS firstName,
    CASE WHEN NOT anon THEN concat('L', CAST(user_id AS VARCHAR)) END AS lastName,
    CASE WHEN NOT anon THEN CASE WHEN user_id % 2 = 0 THEN 'M' ELSE 'F' END END AS gender,
    CASE WHEN NOT anon THEN concat('City', CAST(c_nationkey AS VARCHAR), ', ',
      CASE (c_nationkey + CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END) % 4 WHEN 0 THEN 'CA' WHEN 1 THEN 'TX' WHEN 2 THEN 'PA' ELSE 'WI' END) END
      AS location,
    CASE WHEN NOT anon THEN CASE (user_id + CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END) % 5
      WHEN 0 THEN 'Mozilla/5.0 (Windows NT 6.1; WOW64)'
      WHEN 1 THEN 'Mozilla/5.0 (Macintosh; Intel Mac OS X 10_9_4)'
      WHEN 2 THEN 'Mozilla/5.0 (X11; Linux x86_64)'
      WHEN 3 THEN 'Mozilla/5.0 (iPhone; CPU iPhone OS 7_1)'
      ELSE 'Mozilla/5.0 (iPad; CPU OS 7_1)' END END AS userAgent
  FROM base)"""

_LOG = f"""{_BASE_LOG},
log AS (
  SELECT *, epoch_ms(ts) AS moment, epoch_ms(registration) AS reg_at, hour(epoch_ms(ts)) AS hour,
         right(location, 2) AS state,
         split_part(replace(split_part(userAgent, '(', 2), ';', ' '), ' ', 1) AS device
  FROM activity_log WHERE firstName IS NOT NULL),
labels AS (
  SELECT userId, CAST(max(CASE WHEN page = 'Cancellation Confirmation' THEN 1 ELSE 0 END) AS BIGINT)
    AS label
  FROM log GROUP BY userId)"""

_CALENDAR = """
calendar AS (
  SELECT l_partkey AS listing_id, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS date,
         CASE WHEN l_linenumber <> 7 THEN concat('$', format('{:,.2f}', l_extendedprice)) END
           AS price,
         concat('$', format('{:,.2f}', l_extendedprice)) AS adjusted_price
  FROM lineitem),
parsed AS (
  SELECT listing_id, date, CAST(replace(substr(price, 2), ',', '') AS DOUBLE) AS price,
         CAST(replace(substr(adjusted_price, 2), ',', '') AS DOUBLE) AS adjusted_price
  FROM calendar),
listings AS (
  SELECT p_partkey AS id, CASE WHEN p_type = 'PROMO' THEN p_brand
    ELSE concat(p_type, ' / ', p_brand, ' District') END AS neighbourhood
  FROM part),
days AS (
  SELECT c.listing_id, c.date, c.price, nullif(trim(split_part(l.neighbourhood, '/', 2)), '') AS neighbourhood
  FROM parsed c LEFT JOIN listings l ON c.listing_id = l.id),
by_district AS (
  SELECT neighbourhood, date, avg(price) AS price
  FROM days WHERE neighbourhood IS NOT NULL GROUP BY neighbourhood, date)"""

_MESSAGES = """
messages AS (
  SELECT doc_id AS id, text AS message, CAST(NULL AS VARCHAR) AS original, lang AS genre
  FROM documents),
categories AS (
  SELECT doc_id AS id,
    CASE WHEN doc_id % 7 = 0
      THEN concat('quality-', CAST(quality AS VARCHAR), ';related-', CAST(quality + toxic AS VARCHAR),
                  ';toxic-', CAST(toxic AS VARCHAR))
      ELSE concat('related-', CAST(quality + toxic AS VARCHAR), ';quality-', CAST(quality AS VARCHAR),
                  ';toxic-', CAST(toxic AS VARCHAR)) END AS categories
  FROM labels),
merged AS (SELECT m.*, c.categories FROM messages m JOIN categories c ON m.id = c.id),
wide AS (
  SELECT id, message, original, genre,
    CAST(regexp_extract(categories, 'related-([0-9]+)', 1) AS DOUBLE) AS related,
    CAST(regexp_extract(categories, 'quality-([0-9]+)', 1) AS DOUBLE) AS quality,
    CAST(regexp_extract(categories, 'toxic-([0-9]+)', 1) AS DOUBLE) AS toxic
  FROM merged),
cleaned AS (
  SELECT id, message, original, genre,
    CASE WHEN related = 2 THEN 1.0::DOUBLE ELSE related END AS related,
    CASE WHEN quality = 2 THEN 1.0::DOUBLE ELSE quality END AS quality,
    CASE WHEN toxic = 2 THEN 1.0::DOUBLE ELSE toxic END AS toxic
  FROM (SELECT DISTINCT * FROM wide))"""

_STOP = ", ".join("'" + word.replace("'", "''") + "'" for word in STOP_WORDS)

# Suffix rules written out for SQL: suffix and what stands in its place.
_RULES = """
(VALUES ('s', ''), ('ses', 's'), ('ves', 'f'), ('xes', 'x'), ('zes', 'z'), ('ches', 'ch'),
        ('shes', 'sh'), ('men', 'man'), ('ies', 'y')) AS rules(suffix, ending)"""

_URL_MESSAGES = """
texts AS (
  SELECT d.doc_id AS id, concat_ws(' ', p.url, d.text)
    || CASE WHEN d.doc_id % 10 = 0 THEN ' we wanna go wanna' ELSE '' END AS message
  FROM documents d LEFT JOIN pages p ON p.page_id = d.doc_id)"""


def _lemma_sql(words: str) -> str:
    """CTEs from a (id, position, term) relation to its lemmatised form."""
    return f"""
vocabulary AS (SELECT DISTINCT term FROM {words}),
candidates AS (
  SELECT term AS form, left(term, length(term) - length(suffix)) || ending AS candidate
  FROM vocabulary JOIN {_RULES} ON suffix(term, rules.suffix)
  WHERE length(term) - length(rules.suffix) + length(ending) > 0),
lemmas AS (
  SELECT form, candidate AS lemma FROM (
    SELECT form, candidate,
           row_number() OVER (PARTITION BY form ORDER BY length(candidate), candidate) AS rn
    FROM candidates WHERE candidate IN (SELECT term FROM vocabulary)) WHERE rn = 1),
lemmatised AS (
  SELECT w.id, w.position, coalesce(l.lemma, w.term) AS term
  FROM {words} w LEFT JOIN lemmas l ON w.term = l.form)"""


_TEXT = rf"""{_URL_MESSAGES},
clean AS (
  SELECT id, trim(regexp_replace(regexp_replace(regexp_replace(lower(message),
    'http[^ ]+', 'urlplaceholder', 'g'), '\p{{P}}+', ' ', 'g'), '[\s\p{{Z}}\x{{85}}\x{{1C}}-\x{{1F}}]+', ' ', 'g'))
    AS clean_text
  FROM texts),
padded AS (
  SELECT id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(clean_text,
    '(`+|[$<>])', ' \1 ', 'g'), '\b(wan)(na)( |$)', '\1 \2\3', 'g'),
    '\b(can)(not)\b|\b(gim)(me)\b|\b(gon)(na)\b|\b(got)(ta)\b|\b(lem)(me)\b',
    '\1\3\5\7\9 ', 'g'), ' +', ' ', 'g') AS text
  FROM clean),
lists AS (
  SELECT id, list_filter(string_split(text, ' '), lambda w: w <> '') AS words FROM padded),
words AS (
  SELECT id, position, term FROM (
    SELECT id, unnest(words) AS term, generate_subscripts(words, 1) AS position FROM lists)),
kept AS (SELECT * FROM words WHERE term NOT IN ({_STOP})),
{_lemma_sql("kept")},
counts AS (SELECT id, term, count(*) AS n FROM lemmatised GROUP BY id, term),
frequency AS (SELECT term, count(*) AS df FROM counts GROUP BY term)"""


def _log(name: str, body: str) -> None:
    ORACLE[name] = f"WITH {_LOG}\n{body}"


def _prices(name: str, body: str) -> None:
    ORACLE[name] = f"WITH {_CALENDAR}\n{body}"


def _messages(name: str, body: str) -> None:
    ORACLE[name] = f"WITH {_MESSAGES}\n{body}"


def _text(name: str, body: str) -> None:
    ORACLE[name] = f"WITH {_TEXT}\n{body}"


LOG_COLUMNS = [
    "event_id",
    "userId",
    "sessionId",
    "ts",
    "page",
    "level",
    "artist",
    "song",
    "length",
    "firstName",
    "lastName",
    "gender",
    "location",
    "userAgent",
    "registration",
    "itemInSession",
]
_JSON_COLUMNS = [c for c in LOG_COLUMNS if c != "event_id"]


# --- quality ----------------------------------------------------------------

_nulls = ", ".join(f"count(*) - count({c}) AS {c}" for c in LOG_COLUMNS)
ORACLE["null_counts"] = f"WITH {_BASE_LOG}\nSELECT {_nulls} FROM activity_log"

ORACLE["null_cooccurrence"] = f"WITH {_BASE_LOG}\n" + " UNION ALL ".join(
    f"SELECT '{given}' AS given, '{column}' AS column_name, count(*) - count({column}) AS n_null "
    f"FROM activity_log WHERE {given} IS NULL"
    for given, columns in {
        "artist": ["length", "song"],
        "firstName": ["gender", "lastName", "location", "registration", "userAgent"],
    }.items()
    for column in columns
)
ORACLE["pages_when_null"] = (
    f"WITH {_BASE_LOG}\nSELECT DISTINCT page FROM activity_log WHERE firstName IS NULL"
)
ORACLE["pages_when_not_null"] = (
    f"WITH {_BASE_LOG}\nSELECT DISTINCT page FROM activity_log WHERE artist IS NOT NULL"
)
_log(
    "describe_items",
    """SELECT count(itemInSession) AS count, CAST(round(CAST(avg(itemInSession) AS DECIMAL(38, 9)), 6) AS DOUBLE) AS mean,
       CAST(round(CAST(stddev_samp(itemInSession) AS DECIMAL(38, 9)), 6) AS DOUBLE) AS stddev, min(itemInSession) AS min,
       max(itemInSession) AS max FROM log""",
)
_prices(
    "schema_listing",
    " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, '{kind}' AS data_type, count({name}) AS non_null FROM calendar"
        for name, kind in [
            ("listing_id", "bigint"),
            ("date", "string"),
            ("price", "string"),
            ("adjusted_price", "string"),
        ]
    ),
)
_prices("row_count", "SELECT count(*) AS n_rows, CAST(4 AS BIGINT) AS n_columns FROM calendar")
_prices("listing_nunique", "SELECT count(DISTINCT listing_id) AS n_listings FROM calendar")
_messages(
    "duplicate_rows",
    """SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS n_duplicates FROM (
       SELECT count(*) AS n FROM merged GROUP BY message, original, genre, categories)""",
)
_messages("dedup_messages", "SELECT DISTINCT message, original, genre, categories FROM merged")
_log(
    "preview_events",
    "SELECT userId, page, ts, sessionId, itemInSession FROM log ORDER BY log.ts, event_id LIMIT 100",
)

# --- activity log -----------------------------------------------------------

_clean_columns = ", ".join(
    "CAST(round(CAST(length AS DECIMAL(38, 9)), 6) AS DOUBLE) AS length" if c == "length" else c
    for c in LOG_COLUMNS
    if c != "itemInSession"
)
_log("clean_log", f"SELECT {_clean_columns} FROM log")


def _parts(moment: str, names: list[str]) -> str:
    functions = ["year({})", "month({})", "weekofyear({})", "day({})", "dayofweek({}) + 1", "hour({})"]
    return ", ".join(
        f"CAST({f.format(moment)} AS BIGINT) AS {n}" for f, n in zip(functions, names, strict=True)
    )


_REG_PARTS = ["reg_year", "reg_month", "reg_woy", "reg_dom", "reg_dow", "reg_hour"]
_event_parts = _parts(
    "moment", ["year", "month", "week_of_year", "day_of_month", "day_of_week", "hour"]
)
_log(
    "log_dateparts",
    f"""SELECT event_id, userId, ts, strftime(moment, '%Y-%m-%d %H:%M:%S') AS datetime, {_event_parts}
    FROM log""",
)
_log(
    "registration_dateparts",
    f"""SELECT event_id, userId, registration,
    strftime(reg_at, '%Y-%m-%d %H:%M:%S') AS reg_datetime, {_parts("reg_at", _REG_PARTS)} FROM log""",
)
_log("churn_labels", "SELECT userId, label FROM labels")
_log(
    "churn_labels_union",
    """, gone AS (SELECT DISTINCT userId FROM log WHERE page = 'Cancellation Confirmation')
    SELECT userId, CAST(1 AS BIGINT) AS label FROM gone
    UNION ALL
    SELECT DISTINCT userId, CAST(0 AS BIGINT) AS label FROM log
    WHERE userId NOT IN (SELECT userId FROM gone)""",
)
_log("label_balance", "SELECT label, count(*) AS num_users FROM labels GROUP BY label")
_log(
    "churn_rate",
    """SELECT count(*) AS num_users, count(*) FILTER (label = 1) AS num_churned,
       CAST(round(CAST(avg(label) AS DECIMAL(38, 9)), 6) AS DOUBLE) AS churn_rate FROM labels""",
)
_log(
    "labelled_log",
    "SELECT event_id, userId, page, label FROM log JOIN labels USING (userId)",
)


def _user(aggregates: str) -> str:
    return (
        f"SELECT label, userId, {aggregates} FROM log JOIN labels USING (userId) "
        "GROUP BY label, userId"
    )


def _round(expression: str, name: str, exact: bool) -> str:
    return f"{expression} AS {name}" if exact else f"CAST(round(CAST({expression} AS DECIMAL(38, 9)), 6) AS DOUBLE) AS {name}"


def _lengths(exact: bool = False) -> str:
    return ", ".join(
        _round(expression, f"{name}_length", exact)
        for expression, name in [
            ("sum(length)", "sum"),
            ("avg(length)", "mean"),
            ("max(length)", "max"),
            ("min(length)", "min"),
            ("quantile_disc(length, 0.5)", "median"),
        ]
    )


_PAGE_COUNTS = ", ".join(
    f"count(*) FILTER (page = '{page}') AS {page.lower().replace(' ', '')}_pagecnt"
    for page in ["Error", "Home", "NextSong", "Thumbs Up", "Upgrade"]
)
_HOUR_COUNTS = ", ".join(f"count(*) FILTER (hour = {h}) AS num_pages_hr{h}" for h in range(24))
_HOUR_SHARES = ", ".join(
    f"CAST(round(CAST(count(*) FILTER (hour = {h}) / count(page) AS DECIMAL(38, 9)), 6) AS DOUBLE) AS num_pages_hr{h}" for h in range(24)
)


def _lifetime(exact: bool = False) -> str:
    return _round("(max(ts) - min(registration)) / 1000 / 60 / 60 / 24", "lifetime_day", exact)


def _avg_times(exact: bool = False) -> str:
    return f"""SELECT label, userId, {_round("avg(n)", "avg_times_per_song", exact)} FROM (
      SELECT label, userId, song, count(*) AS n FROM log JOIN labels USING (userId)
      GROUP BY label, userId, song) GROUP BY label, userId"""


_log("artists_per_user", _user("count(DISTINCT artist) AS num_artists"))
_log("length_stats", _user(_lengths()))
_log(
    "song_counts",
    _user("count(song) AS num_songs, count(DISTINCT song) AS num_unique_songs"),
)
_log("avg_times_per_song", _avg_times())
_log(
    "avg_times_per_song_songs_only",
    """SELECT label, userId, CAST(round(CAST(avg(n) AS DECIMAL(38, 9)), 6) AS DOUBLE) AS avg_times_per_song FROM labels LEFT JOIN (
      SELECT userId, song, count(*) AS n FROM log WHERE song IS NOT NULL GROUP BY userId, song)
      USING (userId) GROUP BY label, userId""",
)
_log("lifetime_days", _user(_lifetime()))
_log(
    "page_pivot",
    f"""SELECT label, userId, {_PAGE_COUNTS} FROM log JOIN labels USING (userId)
    WHERE page NOT IN ('Cancellation Confirmation', 'Cancel') GROUP BY label, userId""",
)
_log(
    "page_values",
    """SELECT DISTINCT page FROM log
    WHERE page NOT IN ('Cancellation Confirmation', 'Cancel')""",
)
_log(
    "page_counts",
    """SELECT label, userId, page, count(*) AS num_events FROM log JOIN labels USING (userId)
    WHERE page NOT IN ('Cancellation Confirmation', 'Cancel') GROUP BY label, userId, page""",
)
_log("hour_pivot", f"SELECT userId, {_HOUR_COUNTS} FROM log GROUP BY userId")
_log("hour_pivot_share", _user(_HOUR_SHARES))
_log("hour_share_joined", _user(_HOUR_SHARES))
_RANKED = """, ranked AS (
  SELECT label, userId, hour, num_pages,
    row_number() OVER (PARTITION BY userId ORDER BY num_pages DESC, hour) AS row_number
  FROM (SELECT label, userId, hour, count(page) AS num_pages FROM log JOIN labels USING (userId)
        GROUP BY label, userId, hour))"""
_log("active_hours", f"{_RANKED} SELECT label, userId, hour, num_pages, row_number FROM ranked")
_log(
    "most_active_hour",
    f"""{_RANKED} SELECT label, userId, hour, num_pages, row_number FROM ranked
    WHERE row_number = 1""",
)


def _measured(exact: bool = False) -> str:
    aggregates = f"""count(DISTINCT artist) AS num_artists, {_lengths(exact)},
      max(CASE WHEN level = 'paid' THEN 1 ELSE 0 END)::BIGINT AS is_paid, {_PAGE_COUNTS},
      {_lifetime(exact)}, count(song) AS num_songs, count(DISTINCT song) AS num_unique_songs,
      {_HOUR_SHARES},
      count(*) FILTER (page NOT IN ('Cancellation Confirmation', 'Cancel')) AS others"""
    return f""", measures AS ({_user(aggregates)}),
      song_times AS ({_avg_times(exact)}),
      measured AS (SELECT m.* EXCLUDE (others), avg_times_per_song FROM measures m
        JOIN song_times USING (label, userId) WHERE others > 0)"""


_FEATURES = _measured()
_LATEST = """, latest AS (SELECT userId, gender, state, device FROM (
    SELECT userId, gender, state, device,
      row_number() OVER (PARTITION BY userId ORDER BY log.ts DESC, event_id DESC) AS rn FROM log)
    WHERE rn = 1),
  features AS (SELECT m.*, gender, state, device FROM measured m JOIN latest USING (userId))"""
_log("user_features", f"{_FEATURES}{_LATEST} SELECT * FROM features")
_log(
    "user_features_fanout",
    f"""{_FEATURES} SELECT m.*, gender, state, device FROM measured m
    JOIN (SELECT DISTINCT userId, gender FROM log) USING (userId)
    JOIN (SELECT DISTINCT userId, state FROM log) USING (userId)
    JOIN (SELECT DISTINCT userId, device FROM log) USING (userId)""",
)

# --- exploration ------------------------------------------------------------

_log(
    "sessions_of_user",
    """SELECT count(DISTINCT sessionId) AS num_sessions, count(DISTINCT itemInSession) AS num_items
    FROM log WHERE userId = '8'""",
)
_log(
    "sessions_per_user",
    """SELECT userId, count(DISTINCT sessionId) AS num_sessions,
      count(DISTINCT itemInSession) AS num_items FROM log GROUP BY userId""",
)
_log(
    "events_of_user",
    """SELECT page, strftime(moment, '%Y-%m-%d %H:%M:%S') AS datetime, sessionId, itemInSession
    FROM log WHERE userId = '8' ORDER BY log.ts, sessionId, itemInSession LIMIT 100""",
)


def _by_label(column: str, share: bool) -> str:
    part = (
        f", CAST(round(CAST(num_users / sum(num_users) OVER (PARTITION BY {column}) AS DECIMAL(38, 9)), 6) AS DOUBLE) AS share" if share else ""
    )
    return f"""SELECT label, {column}, num_users{part} FROM (
      SELECT label, {column}, count(DISTINCT userId) AS num_users
      FROM log JOIN labels USING (userId) GROUP BY label, {column})"""


_log("gender_by_label", _by_label("gender", share=True))
_log("state_by_label", _by_label("state", share=False))
_log("device_by_label", _by_label("device", share=True))
_log(
    "level_by_label",
    """SELECT label, is_paid, num_users,
      CAST(round(CAST(num_users / sum(num_users) OVER (PARTITION BY is_paid) AS DECIMAL(38, 9)), 6) AS DOUBLE) AS share
    FROM (SELECT label, is_paid, count(*) AS num_users FROM (
      SELECT label, userId, max(CASE WHEN level = 'paid' THEN 1 ELSE 0 END)::BIGINT AS is_paid
      FROM log JOIN labels USING (userId) GROUP BY label, userId) GROUP BY label, is_paid)""",
)
_log("user_agents", "SELECT DISTINCT userAgent FROM log")
_log(
    "registration_counts",
    f""", users AS (SELECT DISTINCT label, userId, {_parts("reg_at", _REG_PARTS)}
      FROM log JOIN labels USING (userId)) """
    + " UNION ALL ".join(
        f"SELECT label, '{p}' AS part, {p} AS value, count(*) AS num_users FROM users GROUP BY label, {p}"
        for p in _REG_PARTS
    ),
)
_log(
    "hour_label_crosstab",
    f"""{_RANKED} SELECT hour, CAST(round(CAST(count(*) FILTER (label = 0) / count(*) AS DECIMAL(38, 9)), 6) AS DOUBLE) AS stayed,
      CAST(round(CAST(count(*) FILTER (label = 1) / count(*) AS DECIMAL(38, 9)), 6) AS DOUBLE) AS churned
    FROM ranked WHERE row_number = 1 GROUP BY hour""",
)
_log(
    "churn_by_hour",
    """SELECT hour, count(DISTINCT userId) AS num_users FROM log
    WHERE page = 'Cancellation Confirmation' GROUP BY hour""",
)
_MEASURES = [
    "num_artists",
    "sum_length",
    "mean_length",
    "max_length",
    "min_length",
    "median_length",
    "error_pagecnt",
    "home_pagecnt",
    "nextsong_pagecnt",
    "thumbsup_pagecnt",
    "upgrade_pagecnt",
    "lifetime_day",
    "num_songs",
    "num_unique_songs",
    "avg_times_per_song",
]
_LADDER = [1 / 32, 1 / 16, 1 / 8, 1 / 4, 1 / 2, 3 / 4, 7 / 8, 15 / 16, 31 / 32]
_log(
    "measure_quantiles_by_label",
    f"{_measured(exact=True)} "
    + " UNION ALL ".join(
        f"SELECT label, '{m}' AS measure, CAST(round(CAST(CAST({p} AS DOUBLE) AS DECIMAL(38, 9)), 6) AS DOUBLE) AS probability, "
        f"CAST(round(CAST(quantile_cont(CAST({m} AS DOUBLE), {p}) AS DECIMAL(38, 9)), 6) AS DOUBLE) AS quantile "
        "FROM measured GROUP BY label"
        for m in _MEASURES
        for p in _LADDER
    ),
)

# --- prices -----------------------------------------------------------------

_prices(
    "price_parsed",
    "SELECT listing_id, date, CAST(round(CAST(price AS DECIMAL(38, 9)), 6) AS DOUBLE) AS price, CAST(round(CAST(adjusted_price AS DECIMAL(38, 9)), 6) AS DOUBLE) AS adjusted_price "
    "FROM parsed",
)
_prices("price_by_date", "SELECT date, CAST(round(CAST(avg(price) AS DECIMAL(38, 9)), 6) AS DOUBLE) AS price FROM parsed GROUP BY date")
_prices(
    "calendar_with_district",
    "SELECT listing_id, date, CAST(round(CAST(price AS DECIMAL(38, 9)), 6) AS DOUBLE) AS price, neighbourhood FROM days",
)
_prices(
    "price_by_district_date",
    "SELECT neighbourhood, date, CAST(round(CAST(price AS DECIMAL(38, 9)), 6) AS DOUBLE) AS price FROM by_district",
)
_prices("districts", "SELECT DISTINCT neighbourhood FROM by_district")
_prices(
    "district_series",
    """SELECT neighbourhood, date, CAST(round(CAST(price AS DECIMAL(38, 9)), 6) AS DOUBLE) AS price,
      CAST(neighbourhood IN ('Brand#1 District', 'Brand#2 District') AS BIGINT) AS highlighted
    FROM by_district""",
)
_prices(
    "one_district_series",
    """SELECT neighbourhood, date, CAST(round(CAST(price AS DECIMAL(38, 9)), 6) AS DOUBLE) AS price, CAST(0 AS BIGINT) AS highlighted
    FROM by_district WHERE neighbourhood = 'Brand#3 District'""",
)

# --- messages ---------------------------------------------------------------

_messages("messages_merged", "SELECT id, message, original, genre, categories FROM merged")
_messages("categories_wide", "SELECT id, original, genre, related, quality, toxic FROM wide")
_messages("label_matrix", "SELECT related, quality, toxic FROM cleaned")
_messages(
    "categories_long",
    """SELECT id, split_part(item, '-', 1) AS category, CAST(split_part(item, '-', 2) AS DOUBLE) AS value
    FROM (SELECT id, unnest(string_split(categories, ';')) AS item FROM categories)""",
)
_messages(
    "categories_name_check",
    """SELECT id, names FROM (
      SELECT id, regexp_replace(categories, '-[0-9]+', '', 'g') AS names FROM categories)
    WHERE names <> 'related;quality;toxic'""",
)
_messages(
    "category_names",
    """SELECT split_part(item, '-', 1) AS name, min(position) AS position FROM (
      SELECT unnest(string_split(categories, ';')) AS item,
             CAST(unnest(range(len(string_split(categories, ';')))) AS BIGINT) AS position
      FROM categories) GROUP BY name""",
)
_messages("clean_messages", "SELECT * FROM cleaned")
_messages("clean_merged_messages", "SELECT * FROM cleaned")
_messages(
    "genre_counts",
    """SELECT genre, count(message) AS num_messages FROM cleaned WHERE genre IS NOT NULL
    GROUP BY genre""",
)
_messages(
    "category_totals",
    " UNION ALL ".join(
        f"SELECT '{n}' AS category, sum({n}) AS total FROM cleaned"
        for n in ["related", "quality", "toxic"]
    ),
)
_messages(
    "category_display",
    " UNION ALL ".join(
        f"SELECT id, '{n.title()}' AS display_name, CAST({n} = 1 AS BIGINT) AS assigned FROM cleaned"
        for n in ["related", "quality", "toxic"]
    ),
)

# --- text -------------------------------------------------------------------

_joined = "coalesce(string_agg(term, ' ' ORDER BY position), '') AS tokens"
_text("cleaned_text", "SELECT id, clean_text FROM clean")
for _name, _relation in [
    ("tokens", "words"),
    ("tokens_no_stop", "kept"),
    ("lemma_tokens", "lemmatised"),
]:
    _text(
        _name,
        f"SELECT t.id, {_joined} FROM texts t LEFT JOIN {_relation} r ON t.id = r.id GROUP BY t.id",
    )
ORACLE["serving_tokens"] = rf"""WITH {_URL_MESSAGES},
padded AS (
  SELECT id, regexp_replace(regexp_replace(regexp_replace(
    regexp_replace(message, '(`+|[$<>;@#%&?!()\[\]{{}}"])', ' \1 ', 'g'),
    '([:,])([^0-9])', ' \1 \2', 'g'), '([:,])([^0-9])', ' \1 \2', 'g'), '([:,])$', ' \1 ') AS text
  FROM texts),
ended AS (SELECT id, regexp_replace(text, '\.[\s\p{{Z}}\x{{85}}\x{{1C}}-\x{{1F}}]*$', ' . ') AS text FROM padded),
lists AS (
  SELECT id, list_filter(string_split_regex(text, '[\s\p{{Z}}\x{{85}}\x{{1C}}-\x{{1F}}]+'), lambda w: w <> '') AS words
  FROM ended),
words AS (
  SELECT id, position, term FROM (
    SELECT id, unnest(words) AS term, generate_subscripts(words, 1) AS position FROM lists)),
{_lemma_sql("words")}
SELECT t.id, coalesce(string_agg(trim(lower(term)), ' ' ORDER BY position), '') AS tokens
FROM texts t LEFT JOIN lemmatised r ON t.id = r.id GROUP BY t.id"""
_text("noun_lemmas", "SELECT form, lemma FROM lemmas")
_text("doc_frequency", "SELECT term, df FROM frequency")
_text(
    "tfidf_long",
    """, weights AS (
      SELECT id, term, n * (ln((1 + (SELECT count(*) FROM documents)) / (1 + df)) + 1) AS w
      FROM counts JOIN frequency USING (term))
    SELECT id, term, CAST(round(CAST(w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS DECIMAL(38, 9)), 6) AS DOUBLE) AS weight FROM weights""",
)

# --- splits, indexes and reports ---------------------------------------------

_log(
    "index_states",
    f"""{_FEATURES}{_LATEST} SELECT state, count,
      CAST(row_number() OVER (ORDER BY count DESC, state) - 1 AS DOUBLE) AS index
    FROM (SELECT state, count(*) AS count FROM features GROUP BY state)""",
)
_INDEXED = ["gender", "state", "device"]


def _vector_numbers() -> list[str]:
    counted = [p for p in PAGES if p not in ("Cancellation Confirmation", "Cancel")]
    return [
        "num_artists", "sum_length", "mean_length", "max_length", "min_length", "median_length", "is_paid",
        *(p.lower().replace(" ", "") + "_pagecnt" for p in counted),
        "lifetime_day", "num_songs", "num_unique_songs", "avg_times_per_song",
        *(f"num_pages_hr{h}" for h in range(24)), "has_songs",
    ]


def _vectors() -> str:
    numbers = _vector_numbers()
    filled = [
        f"CAST(coalesce({c}, 0) AS DOUBLE) AS {c}" if c != "has_songs"
        else "CAST(CASE WHEN num_songs > 0 THEN 1 ELSE 0 END AS DOUBLE) AS has_songs"
        for c in numbers
    ]
    indexes = "".join(
        f""", {c}_index AS (
      SELECT {c}, CAST(row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS DOUBLE) AS i,
             (SELECT count(DISTINCT {c}) FROM train) AS n
      FROM train GROUP BY {c})"""
        for c in _INDEXED
    )
    unseen = ", ".join(
        f"coalesce((SELECT i FROM {c}_index x WHERE x.{c} = f.{c}), (SELECT CAST(count(*) AS DOUBLE) FROM {c}_index))"
        f" AS {c}_idx"
        for c in _INDEXED
    )
    names = [*numbers, *(f"{c}_idx" for c in _INDEXED)]
    rows = " UNION ALL ".join(
        f"SELECT userId, CAST({k} AS BIGINT) AS position, round({c}, 6) AS value FROM vectors"
        for k, c in enumerate(names)
    )
    return f"""{_FEATURES}{_LATEST}, train AS (
      SELECT * FROM features WHERE substr(md5('2022:' || userId), 1, 8) < 'cccccccc'){indexes},
    vectors AS (SELECT userId, {", ".join(filled)}, {unseen} FROM features f) {rows}"""


_log(
    "split_users",
    """SELECT userId, label,
      CASE WHEN substr(md5('2022:' || userId), 1, 8) < 'cccccccc' THEN 'train' ELSE 'test' END AS side
    FROM labels""",
)
_log(
    "split_users_exact",
    """SELECT userId, label, CASE WHEN row_number() OVER (ORDER BY md5('2022:' || userId))
      <= (SELECT count(*) - ceil(round(count(*) * 0.2, 9)) FROM labels)
      THEN 'train' ELSE 'test' END AS side FROM labels""",
)
_PAIRS = """, pairs AS (
  SELECT 'quality' AS category, quality AS label, related AS prediction FROM cleaned UNION ALL
  SELECT 'toxic' AS category, toxic AS label, related AS prediction FROM cleaned),
classes AS (
  SELECT category, class, count(*) FILTER (label = class) AS support,
    count(*) FILTER (prediction = class) AS predicted,
    count(*) FILTER (label = class AND prediction = class) AS hits
  FROM pairs JOIN (SELECT category, label AS class FROM pairs UNION
                   SELECT category, prediction FROM pairs) c USING (category)
  GROUP BY category, class),
scores AS (
  SELECT category, class, support, hits, CASE WHEN predicted = 0 THEN 0 ELSE hits / predicted END AS precision,
    CASE WHEN support = 0 THEN 0 ELSE hits / support END AS recall,
    2 * hits / (support + predicted) AS f1 FROM classes)"""
_messages(
    "confusion_counts",
    f"{_PAIRS} SELECT category, label, prediction, count(*) AS n FROM pairs GROUP BY ALL",
)
_messages(
    "report_from_labels",
    f"""{_PAIRS}
    SELECT category, CAST(CAST(class AS INTEGER) AS VARCHAR) AS row, CAST(round(CAST(precision AS DECIMAL(38, 9)), 6) AS DOUBLE) AS precision,
      CAST(round(CAST(recall AS DECIMAL(38, 9)), 6) AS DOUBLE) AS recall, CAST(round(CAST(f1 AS DECIMAL(38, 9)), 6) AS DOUBLE) AS f1, support FROM scores
    UNION ALL SELECT category, 'accuracy', NULL, NULL, CAST(round(CAST(sum(hits) / sum(support) AS DECIMAL(38, 9)), 6) AS DOUBLE),
      CAST(sum(support) AS BIGINT) FROM scores GROUP BY category
    UNION ALL SELECT category, 'macro avg', CAST(round(CAST(avg(precision) AS DECIMAL(38, 9)), 6) AS DOUBLE), CAST(round(CAST(avg(recall) AS DECIMAL(38, 9)), 6) AS DOUBLE),
      CAST(round(CAST(avg(f1) AS DECIMAL(38, 9)), 6) AS DOUBLE), CAST(sum(support) AS BIGINT) FROM scores GROUP BY category
    UNION ALL SELECT category, 'weighted avg', CAST(round(CAST(sum(precision * support) / sum(support) AS DECIMAL(38, 9)), 6) AS DOUBLE),
      CAST(round(CAST(sum(recall * support) / sum(support) AS DECIMAL(38, 9)), 6) AS DOUBLE), CAST(round(CAST(sum(f1 * support) / sum(support) AS DECIMAL(38, 9)), 6) AS DOUBLE),
      CAST(sum(support) AS BIGINT) FROM scores GROUP BY category""",
)
_messages(
    "accuracy_and_f1",
    f"""{_PAIRS} SELECT category, CAST(round(CAST(sum(hits) / sum(support) AS DECIMAL(38, 9)), 6) AS DOUBLE) AS accuracy,
      CAST(round(CAST(sum(f1 * support) / sum(support) AS DECIMAL(38, 9)), 6) AS DOUBLE) AS f1 FROM scores GROUP BY category""",
)

# --- sources and sinks ------------------------------------------------------

_json_columns = ", ".join(
    "CAST(round(CAST(length AS DECIMAL(38, 9)), 6) AS DOUBLE) AS length" if c == "length" else c for c in _JSON_COLUMNS
)
ORACLE["json_roundtrip"] = f"WITH {_BASE_LOG}\nSELECT {_json_columns} FROM activity_log"
_prices("csv_roundtrip", "SELECT listing_id, date, price, adjusted_price FROM calendar")
_messages("csv_messages_roundtrip", "SELECT id, message, original, genre FROM messages")
_messages("table_roundtrip", "SELECT * FROM cleaned")

# --- vectors and what fitted models must hold to ------------------------------

_log("feature_vectors", _vectors())
_text(
    "tfidf_vectors",
    """, plain AS (SELECT id, term, count(*) AS n FROM kept GROUP BY id, term),
    seen AS (SELECT term, count(*) AS df FROM plain GROUP BY term),
    weights AS (
      SELECT id, term, n * (ln((1 + (SELECT count(*) FROM documents)) / (1 + df)) + 1) AS w
      FROM plain JOIN seen USING (term))
    SELECT id, term, CAST(round(CAST(w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS DECIMAL(38, 9)), 6) AS DOUBLE) AS weight FROM weights""",
)
_messages(
    "genre_ranking",
    """SELECT genre, num_messages, row_number() OVER (ORDER BY num_messages DESC, genre) AS place
    FROM (SELECT genre, count(message) AS num_messages FROM cleaned WHERE genre IS NOT NULL GROUP BY genre)""",
)
_log(
    "churn_scores_check",
    f"{_FEATURES}{_LATEST} SELECT userId, label, 1::BIGINT AS binary, 1::BIGINT AS same FROM features",
)
# The grid has two values of each of two parameters.
ORACLE["svc_search_check"] = """SELECT 2 * 2::BIGINT AS points, 1::BIGINT AS best_is_highest,
  (SELECT CAST(count(DISTINCT position) AS BIGINT) FROM ({vectors})) AS inputs""".format(
    vectors=ORACLE["feature_vectors"]
)
ORACLE["stream_check"] = """SELECT doc_id AS id, 1::BIGINT AS binary, 1::BIGINT AS same FROM documents"""


# Models and settings are named; their results must hold to what SQL can say of them.
_TEST_USERS = """(SELECT CAST(count(*) AS BIGINT) FROM features
    WHERE substr(md5('2022:' || userId), 1, 8) >= 'cccccccc') AS users"""
_RIGHT = "1::BIGINT AS binary, 1::BIGINT AS same_accuracy, 1::BIGINT AS same_f1"
_MODELS = ["logistic_regression", "linear_svm", "decision_tree", "random_forest", "gradient_boosting"]


def _listed(values: list[str], name: str) -> str:
    return f"unnest([{', '.join(repr(v) for v in values)}]) AS {name}"


_log("compare_models", f"{_FEATURES}{_LATEST} SELECT {_listed(_MODELS, 'model')}, {_TEST_USERS}, {_RIGHT}")
_log("tune_svc", f"{_FEATURES}{_LATEST} SELECT 'linear_svm' AS model, {_TEST_USERS}, {_RIGHT}")
_log(
    "churn_scores",
    f"{_FEATURES}{_LATEST} SELECT userId, label, 1::BIGINT AS binary, 1::BIGINT AS by_margin FROM features",
)
_SVC_POINTS = [f"maxIter={i}, regParam={r}" for i in (50, 100) for r in (0.01, 0.05)]
ORACLE["svc_grid_scores"] = f"SELECT {_listed(_SVC_POINTS, 'params')}, 3::BIGINT AS folds, 1::BIGINT AS same"
_SVC_PARAMS = [
    "aggregationDepth", "featuresCol", "fitIntercept", "labelCol", "maxBlockSizeInMB", "maxIter", "predictionCol",
    "rawPredictionCol", "regParam", "standardization", "threshold", "tol",
]
ORACLE["svc_best_params"] = f"SELECT {_listed(_SVC_PARAMS, 'param')}, 1::BIGINT AS as_expected"
_INPUTS = [*_vector_numbers(), *(f"{c}_idx" for c in _INDEXED)]
ORACLE["svc_coefficients"] = f"""SELECT {_listed(_INPUTS, 'feature')},
  unnest(range({len(_INPUTS)})) AS position, 1::BIGINT AS same"""

_CATEGORY_ROWS = " UNION ALL ".join(
    f"SELECT '{name}' AS category, {name} AS label FROM test WHERE {name} IS NOT NULL" for name in CATEGORY_NAMES
)
# Test messages by hash order, as in the exact split; each class and each summary with its rows.
_REPORT_ROWS = f""", test AS (
    SELECT * FROM cleaned QUALIFY row_number() OVER (ORDER BY md5('2022:' || id))
      > (SELECT count(*) - ceil(round(count(*) * 0.2, 9)) FROM cleaned)),
  labelled AS ({_CATEGORY_ROWS}),
  summed AS (SELECT category, count(*) AS support FROM labelled GROUP BY category)
  SELECT category, CAST(CAST(label AS INTEGER) AS VARCHAR) AS row, count(*) AS support, 1::BIGINT AS same
  FROM labelled GROUP BY category, label
  UNION ALL SELECT category, unnest(['accuracy', 'macro avg', 'weighted avg']), support, 1::BIGINT FROM summed"""
_messages("message_report", _REPORT_ROWS)
_messages("message_report_lemmas", _REPORT_ROWS)


def _searched(points: list[str]) -> str:
    """15 fits for each point: one per label and fold."""
    return f"SELECT {_listed(points, 'params')}, {len(CATEGORY_NAMES) * 5}::BIGINT AS fits, 1::BIGINT AS same"


ORACLE["message_grid"] = _searched([f"minInstancesPerNode={n}, numTrees={t}" for t in (10, 100) for n in (1, 2)])
ORACLE["message_grid_notebook"] = _searched([f"maxDepth={d}, minInstancesPerNode={n}" for d in (3, 5, 10) for n in (1, 3)])
ORACLE["score_batch"] = f"""SELECT doc_id AS id, {_listed([n.title() for n in CATEGORY_NAMES], 'display_name')},
  1::BIGINT AS binary, 1::BIGINT AS same FROM documents"""
ORACLE["score_stream"] = """SELECT doc_id AS id, lang AS genre, count(*) AS times, 1::BIGINT AS scored
  FROM documents GROUP BY ALL"""
