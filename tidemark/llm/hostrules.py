"""Host-level quality rules, on DataFrame functions alone.

Every document is measured once: words, characters in words, symbols, repeated lines
and words in repeated windows. Rules turn the measures into failures. Failures are
summed by host (``source``), and each host's failure rate is shrunk towards the rate of
the whole corpus by a beta prior, whose strength is estimated from how much hosts
differ beyond chance. So a host of two bad documents isn't condemned on them, and a
large one speaks for itself. The verdict on the host is joined back to its documents:

- ``rejected``, shrunk rate of at least ``REJECT``: all of its documents go;
- ``mixed``: documents that fail a rule go;
- ``trusted``, shrunk rate below ``TRUST``: only the base rules count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources import stored

# Base rules.
LEAST_WORDS = 20
MOST_REPEATED = 30
# Words of a window; a power of two.
WINDOW = 8
# A document also fails with a symbol to so many words, or as many repeated lines of a hundred.
WORDS_TO_SYMBOL = 10
MOST_DUP_LINES = 50
# Shrunk failure rates.
TRUST, REJECT = 0.01, 0.5
# Bounds of the correlation inside hosts: a prior worth 2 to 10,000 documents.
LEAST_RHO, MOST_RHO = 1 / 10_001, 1 / 3

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"


def _without(text: Column, characters: str) -> Column:
    return F.length(F.translate(text, characters, ""))


def _rest(array: str, after: int) -> Column:
    """An array without its first elements; null-padded by ``zip_with``."""
    return F.slice(array, F.lit(after + 1), F.greatest(F.size(array) - after, F.lit(0)))


def _with_windows(words: DataFrame) -> DataFrame:
    """Add ``windows``: a hash of each run of ``WINDOW`` words, in order.

    Hashes of runs double in length: two of length n make one of length 2n, so a
    window costs log2(WINDOW) hashes and no array of its own. Each step reads its
    input twice, which keeps Spark from computing it inside the next step's lambda.
    """
    found = words.withColumn("windows", F.transform("words", lambda word: F.xxhash64(word)))
    length = 1
    while length < WINDOW:
        pairs = F.zip_with("windows", _rest("windows", length), lambda a, b: F.xxhash64(a, b))
        found = found.withColumn("windows", F.slice(pairs, F.lit(1), F.greatest(F.size("windows") - length, F.lit(0))))
        length *= 2
    return found


def measured(docs: DataFrame, host: str = "source") -> DataFrame:
    """(doc_id, host, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words) per row.

    ``host`` is "+" and the value of the host column, "-" for null. Windows are
    compared by 64-bit hash, inside their text only.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    named = F.when(F.col(host).isNull(), "-").otherwise(F.concat(F.lit("+"), F.col(host).cast("string")))
    whole = docs.select("doc_id", named.alias("host"), text.alias("text"))
    whole = whole.select(
        "doc_id",
        "host",
        _without(F.col("text"), BLANKS).cast("bigint").alias("word_chars"),
        (F.length("text") - _without(F.col("text"), SYMBOLS)).cast("bigint").alias("n_symbols"),
        F.filter(F.split("text", "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        F.filter(F.split("text", r"[\x20\x09-\x0D]+", -1), lambda word: word != "").alias("words"),
    )
    narrow = whole.select(
        "doc_id",
        "host",
        F.size("words").cast("bigint").alias("n_words"),
        "word_chars",
        "n_symbols",
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        "words",
    )
    windows = _with_windows(narrow).drop("words")
    # Only texts with a repeated window are sorted: equal hashes then stand side by side.
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    beside = windows.withColumn("placed", F.when(repeats, placed)).drop("windows")
    twice = F.zip_with(
        "placed", _rest("placed", 1), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>"))
    )
    starts = beside.withColumn("starts", F.sort_array(F.array_distinct(F.flatten(twice)))).drop("placed")
    # A window covers its words up to the next window that starts inside it.
    covers = F.zip_with("starts", _rest("starts", 1), lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
    covered = F.aggregate(covers, F.lit(0).cast("bigint"), lambda total, n: total + n)
    return starts.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("bigint")).drop("starts")


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def rule_failed() -> Column:
    """Base rules, too many symbols, or too many repeated lines."""
    symbols = WORDS_TO_SYMBOL * F.col("n_symbols") > F.col("n_words")
    lines = 100 * F.col("n_dup_lines") > MOST_DUP_LINES * F.col("n_lines")
    return base_failed() | symbols | lines


def host_rates(measures: DataFrame) -> DataFrame:
    """(host, n_docs, n_failed, shrunk_rate, verdict), one row per host.

    With hosts of n documents and f failures, N documents and mean rate m in all, the
    correlation inside hosts is rho = (sum(f^2 / n) - N m^2 - (k - 1) m (1 - m)) /
    (m (1 - m) (N - sum(n^2) / N - (k - 1))) for k hosts, kept between ``LEAST_RHO`` and
    ``MOST_RHO``. The prior is worth s = 1 / rho - 1 documents at rate m, so the shrunk
    rate is (f + s m) / (n + s). With a single host, or rates of 0 or 1 throughout, hosts
    tell nothing about how they differ: the prior is then as weak as it may be.
    """
    failed = F.sum(rule_failed().cast("bigint")).alias("n_failed")
    hosts = stored(measures.groupBy("host").agg(F.count(F.lit(1)).alias("n_docs"), failed), "host-rates")
    n, f = F.col("n_docs").cast("double"), F.col("n_failed").cast("double")
    # Sums of decimals do not depend on their order.
    exact = "decimal(38,9)"
    total = hosts.agg(
        F.sum("n_docs").cast("double").alias("n"),
        F.sum("n_failed").cast("double").alias("f"),
        F.count(F.lit(1)).cast("double").alias("k"),
        F.sum((f * f / n).cast(exact)).cast("double").alias("ff"),
        F.sum((n * n).cast(exact)).cast("double").alias("nn"),
    )
    mean = F.col("f") / F.col("n")
    chance = mean * (1 - mean)
    rho = F.try_divide(
        F.col("ff") - F.col("n") * mean * mean - (F.col("k") - 1) * chance,
        chance * (F.col("n") - F.col("nn") / F.col("n") - (F.col("k") - 1)),
    )
    rho = F.least(F.greatest(F.coalesce(rho, F.lit(MOST_RHO)), F.lit(LEAST_RHO)), F.lit(MOST_RHO))
    prior = total.filter("n > 0").select(mean.alias("mean"), (1 / rho - 1).alias("strength"))
    # One row of two numbers, as scalar subqueries.
    mean, strength = prior.select("mean").scalar(), prior.select("strength").scalar()
    shrunk = hosts.withColumn("shrunk_rate", (f + strength * mean) / (n + strength))
    rate = F.col("shrunk_rate")
    return shrunk.withColumn("verdict", F.when(rate >= REJECT, "rejected").when(rate < TRUST, "trusted").otherwise("mixed"))


def judged(docs: DataFrame, host: str = "source") -> DataFrame:
    """Measures, base_failed, host_verdict and kept of every row of ``docs``.

    Null texts count as empty, and as too short, so they go; documents without a host
    are one host. A rate equal to ``REJECT`` rejects, one equal to ``TRUST`` is mixed.
    Rows that repeat, or share an id, count and are returned one by one; a null
    doc_id stays null. An empty table gives an empty one. Columns other than doc_id,
    text and the host are not read. The host table has a row per host: it is
    broadcast while small, else joined on the host, where Spark splits a hot one.
    """
    measures = stored(measured(docs, host), "host-measures")
    verdicts = stored(host_rates(measures).select("host", F.col("verdict").alias("host_verdict")), "host-verdicts")
    joined = measures.join(verdicts, "host")
    goes = base_failed() | (F.col("host_verdict") == "rejected") | ((F.col("host_verdict") == "mixed") & rule_failed())
    return joined.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed().alias("base_failed"),
        "host_verdict",
        (~goes).alias("kept"),
    )


ORACLE = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, CASE WHEN source IS NULL THEN '-' ELSE '+' || source END AS host,
         coalesce(text, '') AS text FROM documents
), split AS (
  SELECT r, doc_id, host, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM texts
), windows AS (
  SELECT r, i, array_to_string(words[i:i + {WINDOW - 1}], ' ') AS w
  FROM (SELECT r, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM split WHERE len(words) >= {WINDOW})
), twice AS (
  SELECT r, w FROM windows GROUP BY r, w HAVING count(*) > 1
), covered AS (
  SELECT r, count(DISTINCT spot) AS n FROM (
    SELECT w.r, unnest(range(w.i, w.i + {WINDOW})) AS spot FROM windows w JOIN twice t ON w.r = t.r AND w.w = t.w
  ) GROUP BY r
), measures AS (
  SELECT s.r, doc_id, host, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         len(lines) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
  FROM split s LEFT JOIN covered c ON s.r = c.r
), base AS (
  SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed FROM measures
), rules AS (
  SELECT *, base_failed OR {WORDS_TO_SYMBOL} * n_symbols > n_words
            OR 100 * n_dup_lines > {MOST_DUP_LINES} * n_lines AS failed FROM base
), hosts AS (
  SELECT host, CAST(count(*) AS DOUBLE) AS n, CAST(sum(failed::INT) AS DOUBLE) AS f FROM rules GROUP BY host
), total AS (
  SELECT sum(n) AS n, sum(f) / sum(n) AS m, count(*) - 1 AS k, sum(f * f / n) AS ff, sum(n * n) AS nn FROM hosts
), prior AS (
  SELECT m, 1 / least(greatest(coalesce(CASE WHEN m * (1 - m) * (n - nn / n - k) = 0 THEN NULL
         ELSE (ff - n * m * m - k * m * (1 - m)) / (m * (1 - m) * (n - nn / n - k)) END, {MOST_RHO}), {LEAST_RHO}), {MOST_RHO}) - 1 AS s
  FROM total
), verdicts AS (
  SELECT host, CASE WHEN (f + s * m) / (n + s) >= {REJECT} THEN 'rejected'
                    WHEN (f + s * m) / (n + s) < {TRUST} THEN 'trusted' ELSE 'mixed' END AS host_verdict
  FROM hosts, prior
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, host_verdict,
       NOT (base_failed OR host_verdict = 'rejected' OR (host_verdict = 'mixed' AND failed)) AS kept
FROM rules JOIN verdicts USING (host)
"""
