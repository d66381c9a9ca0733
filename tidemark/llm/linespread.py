"""Line dedup by distinct-site spread, on DataFrame functions alone.

Lines are compared by hash. Per hash a HyperLogLog sketch of the sites it occurs on
is built by aggregation: tasks sketch their own rows, the sketches merge in the
shuffle. Lines that are clearly below or above the threshold are settled by the
estimate, the band between by exact distinct counts. A line that is found on enough
sites is boilerplate: its first occurrence stays, the others go.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import same_key, text_key
from tidemark.sources import stored

MIN_SITES = 5
LG_CONFIG = 12
# Standard errors of the estimate on either side of the threshold that are counted exactly.
BAND = 6
# Least half width of that band, for thresholds so small that a relative error says nothing.
LEAST_BAND = 2


def lines_of(text: str = "text"):
    """The lines of a text, split at line feeds; null counts as empty."""
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)


def occurrences(docs: DataFrame, site: str = "source") -> DataFrame:
    """(doc_id, text_key, site, pos, line) for every line that is not blank.

    ``line`` is a 64-bit hash of the line without blanks at its ends; no site is a
    site of its own.
    """
    named = F.when(F.col(site).isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.col(site).cast("string")))
    # The digest is taken before the lines part, or each line would take it of the whole text.
    whole = docs.select("doc_id", text_key().alias("text_key"), named.alias("site"), lines_of().alias("lines"))
    parts = whole.select("doc_id", "text_key", "site", F.posexplode("lines").alias("pos", "value"))
    trimmed = F.regexp_replace("value", r"^[ \t\r]+|[ \t\r]+$", "")
    bare = parts.select("doc_id", "text_key", "site", "pos", trimmed.alias("value")).filter(F.length("value") > 0)
    return bare.select("doc_id", "text_key", "site", "pos", F.xxhash64("value").alias("line"))


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES, lg_config: int = LG_CONFIG) -> DataFrame:
    """The hashes of lines found on at least ``min_sites`` distinct sites, each once."""
    error = 1.04 / (2 ** (lg_config / 2))
    band = max(LEAST_BAND, BAND * error * min_sites)
    spread = lines.groupBy("line").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", lg_config)).alias("estimate")
    )
    spread = stored(spread.filter(F.col("estimate") >= min_sites - band), "line-spread")
    sure = spread.filter(F.col("estimate") > min_sites + band).select("line")
    near = spread.filter(F.col("estimate") <= min_sites + band).select("line")
    exact = (
        lines.join(near, "line", "left_semi")
        .select("line", "site")
        .distinct()
        .groupBy("line")
        .agg(F.count(F.lit(1)).alias("sites"))
        .filter(F.col("sites") >= min_sites)
        .select("line")
    )
    return sure.unionByName(exact)


def removals(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES, lg_config: int = LG_CONFIG) -> DataFrame:
    """(doc_id, text_key, removed): the positions of the lines that each affected document loses.

    The first occurrence of a line, by doc_id (no id last), text digest and
    position, stays. Rows that repeat wholly have the same removals. Neither step
    deals occurrences out by line, so a line that many documents hold is spread as
    they are: the first is a minimum that tasks take of their own rows before they
    meet, and what stays is taken out of what goes by document.
    """
    lines = stored(occurrences(docs, site), "lines")
    common = stored(boilerplate(lines, min_sites, lg_config), "boilerplate")
    hits = stored(lines.join(common, "line", "left_semi").select("line", "doc_id", "text_key", "pos"), "boilerplate-lines")
    first = hits.groupBy("line").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key", "pos")).alias("at"))
    stay = first.select("at.doc_id", "at.text_key", F.lit(None).cast("int").alias("goes"), F.col("at.pos").alias("stays"))
    every = hits.select("doc_id", "text_key", F.col("pos").alias("goes"), F.lit(None).cast("int").alias("stays"))
    # Null positions aren't collected.
    extra = F.array_except(F.collect_set("goes"), F.collect_set("stays"))
    found = every.unionByName(stay).groupBy("doc_id", "text_key").agg(extra.alias("removed"))
    return found.filter(F.size("removed") > 0)


def _cleaned(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(row, text, lines, removed) for every row; the text is null where it was null."""
    rows = docs.select("doc_id", text_key().alias("text_key"), F.struct("*").alias("row"))
    joined = rows.join(found, same_key(rows, found, ["doc_id", "text_key"]), "left")
    joined = joined.select("row", "removed", F.split(F.coalesce("row.text", F.lit("")), "\n", -1).alias("lines"))
    lines, gone = F.col("lines"), F.col("removed")
    # A difference of sets takes time in proportion to the lines, however many go.
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
    return joined.select(
        "row",
        F.when(gone.isNull(), F.col("row.text"))
        .otherwise(F.array_join(F.transform(kept, lambda at: F.get(lines, at)), "\n"))
        .alias("text"),
        F.size(lines).cast("bigint").alias("lines"),
        F.when(gone.isNull(), 0).otherwise(F.size(gone)).cast("bigint").alias("removed"),
    )


def line_dedup(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES, lg_config: int = LG_CONFIG) -> DataFrame:
    """The rows of ``docs``, all columns, without repeated cross-site boilerplate lines.

    ``n_chars``, if there, is set to the length of the new text. No row goes: a
    document all of whose lines went has an empty text. Null texts stay null.
    """
    cleaned = _cleaned(docs, removals(docs, site, min_sites, lg_config))
    columns = []
    for field in docs.schema.fields:
        column = F.col("row").getField(field.name)
        if field.name == "text":
            column = F.col("text")
        elif field.name == "n_chars":
            column = F.when(F.col("removed") > 0, F.length("text")).otherwise(column).cast(field.dataType)
        columns.append(column.alias(field.name))
    return cleaned.select(*columns)


def report(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES, lg_config: int = LG_CONFIG) -> DataFrame:
    """(doc_id, n_lines, n_removed, text) of every row after the dedup.

    A null text is one empty line and stays null; a null site is a site of its own, no
    id comes after all ids. Rows that repeat, or share an id, are returned one by one.
    An empty table gives an empty one; columns other than doc_id, text and the site
    aren't read.
    """
    cleaned = _cleaned(docs, removals(docs, site, min_sites, lg_config))
    return cleaned.select(
        F.col("row.doc_id").alias("doc_id"), F.col("lines").alias("n_lines"), F.col("removed").alias("n_removed"), "text"
    )


# Sites are counted exactly here; the query's sketches only spare that work.
ORACLE = r"""
WITH texts AS (
  SELECT doc_id, source, text, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
), spots AS (
  SELECT doc_id, source, text, parts, unnest(range(1, len(parts) + 1)) AS pos FROM texts
), lines AS (
  SELECT doc_id, source, text, pos, trim(parts[pos], ' ' || chr(9) || chr(13)) AS line FROM spots
), common AS (
  SELECT line FROM lines WHERE length(line) > 0 GROUP BY line
  HAVING count(DISTINCT coalesce('+' || source, '-')) >= 5
), hits AS (
  SELECT l.doc_id, l.text, l.pos, l.line,
         dense_rank() OVER (PARTITION BY l.line ORDER BY l.doc_id NULLS LAST, l.pos) AS nth
  FROM lines l JOIN common c ON l.line = c.line
), gone AS (
  SELECT doc_id, list(DISTINCT pos) AS removed FROM hits WHERE nth > 1 GROUP BY doc_id
)
SELECT t.doc_id, CAST(len(t.parts) AS BIGINT) AS n_lines,
       CAST(coalesce(len(g.removed), 0) AS BIGINT) AS n_removed,
       CASE WHEN g.removed IS NULL THEN t.text
            ELSE array_to_string(list_transform(list_filter(range(1, len(t.parts) + 1),
                 lambda i: NOT list_contains(g.removed, i)), lambda i: t.parts[i]), chr(10)) END AS text
FROM texts t LEFT JOIN gone g ON t.doc_id = g.doc_id
"""
