"""URL filters: host and path rules, and a character language-model ratio for the rest.

Urls that a rule settles train two variable-order Markov models of characters, one of
allowed and one of blocked urls. A gram is a character with the ``k`` before it. Its
probability is smoothed by that of the next shorter gram:
``p(c | h) = (n(hc) + STRENGTH * p(c | h')) / (n(h) + STRENGTH)``, where n counts the
grams that occur at least ``LEAST_COUNT`` times, and n(h) those that go on from h. At each position the
longest gram seen in training decides, and a url's score is the mean over its
positions of the difference of log probabilities. Since shorter grams of a gram that
was seen were seen too, each gram can carry the difference to the next shorter one,
and the sum over all grams of a url is the sum over its longest: a join with the model
and one sum. The models are tables of any size; nothing of them goes to the driver.

A fold of the ruled urls stays out of training and calibrates the threshold.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources import stored

ORDER = 5
LEAST_COUNT = 2
STRENGTH = 1.0
# Size of the alphabet for characters that were never seen.
ALPHABET = 128
FOLDS = 5
# Scores are calibrated in steps of 1/100 between -10 and 10.
STEPS, MOST = 100, 1000
# Positions of a text that are read from one piece of it.
PIECE = 256
# Sums run in whole numbers of 2^-32, so their order does not matter.
UNIT = 1 << 32

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """A verdict for a host with all its subdomains, and paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @classmethod
    def parse(cls, verdict: str, text: str) -> Rule:
        host, slash, path = text.partition("/")
        return cls(verdict, host, slash + path)

    @property
    def text(self) -> str:
        return self.host + self.path


# The rules of the query.
RULES = [
    Rule.parse("allow", "com/"),
    Rule.parse("block", "example.com/en/"),
    Rule.parse("allow", "www.example.com/en/"),
    Rule.parse("block", "net/es/"),
    Rule.parse("block", "net/fr/"),
]


def host_of(url: str = "url") -> Column:
    found = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, _UPPER, _LOWER)


def path_of(url: str = "url") -> Column:
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(rules: list[Rule]) -> Column:
    """The longest rule that fits ``host`` and ``path``, as struct (rule, verdict); null if none."""
    column = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        fits = ((F.col("host") == rule.host) | F.col("host").endswith("." + rule.host)) & F.col("path").startswith(rule.path)
        column = F.when(fits, F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(column)
    return column


def grams(texts: DataFrame, keep: list[str], order: int = ORDER) -> DataFrame:
    """The columns ``keep``, gram and k, for each position of ``text`` and its end, and each order."""
    padded = texts.select(*keep, F.concat(F.lit("\x02" * order), F.col("text"), F.lit("\x03")).alias("padded"))
    # Pieces that overlap by the order, so that a position carries its piece and not a long text.
    starts = F.sequence(F.lit(0), F.length("padded") - order - 1, F.lit(PIECE))
    pieces = F.transform(starts, lambda at: F.substring(F.col("padded"), at + 1, F.lit(PIECE + order)))
    cut = padded.select(*keep, F.explode(pieces).alias("piece"))
    spots = cut.select(*keep, "piece", F.explode(F.sequence(F.lit(0), F.length("piece") - order - 1)).alias("at"))
    each = F.array(*[
        F.struct(F.lit(k).alias("k"), F.substring(F.col("piece"), F.col("at") + (order + 1 - k), F.lit(k + 1)).alias("gram"))
        for k in range(order + 1)
    ])
    return spots.select(*keep, F.explode(each).alias("g")).select(*keep, "g.k", "g.gram")


def train(texts: DataFrame, order: int = ORDER, least: int = LEAST_COUNT, strength: float = STRENGTH) -> DataFrame:
    """(gram, delta): what each gram adds to the score, in units.

    ``texts`` has ``text``, ``allowed`` and ``blocked`` (0 or 1). Counts cover all of them.
    """
    counted = grams(texts, ["allowed", "blocked"], order).groupBy("k", "gram").agg(
        F.sum("allowed").cast("double").alias("a"), F.sum("blocked").cast("double").alias("b")
    )
    counted = stored(counted.filter(F.col("a") + F.col("b") >= least), "grams")
    shorter, levels = None, []
    for k in range(order + 1):
        here = counted.filter(F.col("k") == k).withColumn("context", F.substring("gram", 1, k))
        # A context has at most as many grams as there are characters.
        totals = here.groupBy("context").agg(F.sum("a").alias("all_a"), F.sum("b").alias("all_b"))
        here = here.join(totals, "context")
        if shorter is None:
            uniform = F.lit(1.0 / ALPHABET)
            here = here.withColumns({"below_a": uniform, "below_b": uniform})
        else:
            below = shorter.select(
                F.col("gram").alias("tail"), F.col("p_a").alias("below_a"), F.col("p_b").alias("below_b")
            )
            here = here.withColumn("tail", F.substring("gram", 2, k)).join(below, "tail")
        here = here.select(
            "gram",
            ((F.col("a") + strength * F.col("below_a")) / (F.col("all_a") + strength)).alias("p_a"),
            ((F.col("b") + strength * F.col("below_b")) / (F.col("all_b") + strength)).alias("p_b"),
            "below_a",
            "below_b",
        )
        shorter = stored(here, f"grams-{k}")
        levels.append(shorter)
    model = levels[0]
    for level in levels[1:]:
        model = model.unionByName(level)
    step = F.log(F.col("p_a")) - F.log(F.col("p_b")) - F.log(F.col("below_a")) + F.log(F.col("below_b"))
    return model.select("gram", F.round(step * UNIT).cast("bigint").alias("delta"))


def scores(texts: DataFrame, model: DataFrame, order: int = ORDER) -> DataFrame:
    """(text, score) of every distinct text: mean log-likelihood difference per position.

    A text none of whose characters was seen scores 0, an empty one by its end alone.
    """
    # A digest of 16 bytes stands for the text, however long, in what is shuffled by gram.
    named = texts.select("text", F.unhex(F.md5(F.col("text").cast("binary"))).alias("name"))
    # Repeats of a gram in a text are counted before the join; so are hot grams spread.
    own = grams(named, ["name"], order).groupBy("name", "gram").agg(F.count(F.lit(1)).alias("times"))
    hits = own.join(model, "gram").groupBy("name").agg(F.sum(F.col("times") * F.col("delta")).alias("total"))
    joined = named.join(hits, "name", "left")
    mean = F.coalesce(F.col("total"), F.lit(0)) / UNIT / (F.length("text") + 1)
    return joined.select("text", mean.alias("score"))


def threshold(scored: DataFrame) -> float:
    """The score from which allowing is right most often for both kinds of ruled urls alike.

    ``scored`` has score, allowed and blocked; at most 2 * MOST + 1 counts reach the driver.
    Without urls of both kinds the threshold is 0.
    """
    step = F.greatest(F.least(F.floor(F.col("score") * STEPS), F.lit(MOST)), F.lit(-MOST)).alias("step")
    counts = scored.groupBy(step).agg(F.sum("allowed").alias("a"), F.sum("blocked").alias("b")).orderBy("step").collect()
    all_a, all_b = sum(r.a for r in counts), sum(r.b for r in counts)
    if not all_a or not all_b:
        return 0.0
    # Allowing from this step on: allowed urls below are lost, blocked ones below are caught.
    best, found, below, lost, caught, previous = -1.0, 0, 0, 0, 0, counts[0].step - 1
    for row in counts:
        right = (all_a - lost) / all_a + caught / all_b
        if right > best + 1e-12:
            best, found, below = right, row.step, previous
        lost, caught, previous = lost + row.a, caught + row.b, row.step
    # The middle of the gap between the step before, up to its end, and this one.
    return (found + below + 1) / 2 / STEPS


def judged(pages: DataFrame, rules: list[Rule] = RULES, order: int = ORDER) -> DataFrame:
    """(page_id, host, path, rule, verdict, score, threshold) of every page.

    Host and path are empty for a url that is null or lacks ``://``; such a url is
    judged by the models like any other without a rule. The models read host and path
    with every digit as 0, each distinct text once, however many pages have it. They
    score every page, so that a rule can be held against them; without a rule a score
    equal to the threshold allows. Repeated pages, and pages without an id, are judged
    one by one; an empty table gives an empty one. Other columns aren't read.
    """
    text = F.translate(F.concat("host", "path"), "123456789", "000000000")
    parsed = pages.select("page_id", host_of().alias("host"), path_of().alias("path")).withColumn("text", text)
    parsed = parsed.withColumn("fit", rule_of(rules))
    kind = F.col("fit.verdict")
    texts = parsed.groupBy("text").agg(
        F.max(F.when(kind == "allow", 1).otherwise(0)).alias("allowed"),
        F.max(F.when(kind == "block", 1).otherwise(0)).alias("blocked"),
    )
    digest = F.conv(F.substring(F.md5(F.col("text").cast("binary")), 1, 8), 16, 10).cast("bigint")
    texts = stored(texts.withColumn("held", digest % FOLDS == 0), "url-texts")
    ruled = (F.col("allowed") == 1) | (F.col("blocked") == 1)
    model = stored(train(texts.filter(ruled & ~F.col("held")), order), "url-model")
    scored = stored(scores(texts, model, order), "url-scores")
    limit = threshold(scored.join(texts.filter(ruled & F.col("held")), "text"))
    by_model = F.when(F.coalesce(F.col("score"), F.lit(0.0)) >= limit, "allow").otherwise("block")
    return parsed.join(scored, "text", "left").select(
        "page_id", "host", "path", F.col("fit.rule").alias("rule"),
        F.coalesce(F.col("fit.verdict"), by_model).alias("verdict"), "score", F.lit(limit).alias("threshold"),
    )


def _oracle(rules: list[Rule] = RULES, order: int = ORDER) -> str:
    """The same rules, models and threshold in SQL; one CTE per length of a gram."""
    fits = " ".join(
        f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{{}}'"
        for r in sorted(rules, key=lambda r: -len(r.text))
    )
    ranked = sorted(rules, key=lambda r: -len(r.text))
    levels = []
    for k in range(order + 1):
        below = f"{1 / ALPHABET}::DOUBLE" if k == 0 else "s.p_{}"
        joined = "" if k == 0 else f" JOIN l{k - 1} s ON s.gram = substr(g.gram, 2)"
        parts = [f"(g.{c} + {STRENGTH}::DOUBLE * {below.format(c)}) / (t.{c} + {STRENGTH}::DOUBLE) AS p_{c}" for c in "ab"]
        kept = [f"{below.format(c)} AS below_{c}" for c in "ab"]
        levels.append(f"""l{k} AS (
  SELECT g.gram, {", ".join([*parts, *kept])} FROM counted g
  JOIN (SELECT left(gram, {k}) AS context, sum(a) AS a, sum(b) AS b FROM counted WHERE k = {k} GROUP BY 1) t
    ON t.context = left(g.gram, {k}){joined} WHERE g.k = {k})""")
    model = " UNION ALL ".join(f"SELECT * FROM l{k}" for k in range(order + 1))
    grams_of = f"""SELECT {{}}, k, substr(padded, CAST(at_ + {order + 1} - k AS BIGINT), CAST(k + 1 AS BIGINT)) AS gram
  FROM (SELECT *, unnest(range({order + 1})) AS k FROM (
    SELECT *, repeat(chr(2), {order}) || text || chr(3) AS padded, unnest(range(length(text) + 1)) AS at_ FROM {{}}))"""
    return rf"""
WITH parsed AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages
), fitted AS (
  SELECT *, regexp_replace(host || path, '[1-9]', '0', 'g') AS text,
         CASE {fits.format(*(r.text for r in ranked))} END AS rule, CASE {fits.format(*(r.verdict for r in ranked))} END AS ruled
  FROM parsed
), texts AS (
  SELECT text, max((ruled = 'allow')::INT) AS allowed, max((ruled = 'block')::INT) AS blocked,
         max((ruled IS NULL)::INT) AS open, CAST('0x' || left(md5(text), 8) AS BIGINT) % {FOLDS} = 0 AS held
  FROM fitted GROUP BY text
), sides AS (
  SELECT text, coalesce(allowed, 0) AS allowed, coalesce(blocked, 0) AS blocked, open, held FROM texts
), training AS (SELECT * FROM sides WHERE allowed + blocked > 0 AND NOT held
), counted AS (
  SELECT k, gram, CAST(sum(allowed) AS DOUBLE) AS a, CAST(sum(blocked) AS DOUBLE) AS b
  FROM ({grams_of.format("allowed, blocked", "training")}) GROUP BY k, gram HAVING sum(allowed) + sum(blocked) >= {LEAST_COUNT}
), {", ".join(levels)}, model AS (
  SELECT gram, CAST(round((ln(p_a) - ln(p_b) - ln(below_a) + ln(below_b)) * {UNIT}) AS BIGINT) AS delta FROM ({model})
), wanted AS (SELECT * FROM sides WHERE open = 1 OR (allowed + blocked > 0 AND held)
), sums AS (
  SELECT text, sum(delta) AS total FROM ({grams_of.format("text", "wanted")}) JOIN model USING (gram) GROUP BY text
), scored AS (
  SELECT w.*, CAST(coalesce(total, 0) AS DOUBLE) / {UNIT} / (length(w.text) + 1) AS score
  FROM wanted w LEFT JOIN sums s ON w.text = s.text
), steps AS (
  SELECT greatest(least(floor(score * {STEPS}), {MOST}), -{MOST}) AS step, sum(allowed) AS a, sum(blocked) AS b
  FROM scored WHERE held AND allowed + blocked > 0 GROUP BY 1
), running AS (
  SELECT step, coalesce(lag(step) OVER w, step - 1) AS below, sum(a) OVER () AS all_a, sum(b) OVER () AS all_b,
         coalesce(sum(a) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lost,
         coalesce(sum(b) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS caught
  FROM steps WINDOW w AS (ORDER BY step)
), limits AS (
  SELECT coalesce((SELECT (step + below + 1) / 2 / {STEPS} FROM running WHERE all_a > 0 AND all_b > 0
    ORDER BY round((all_a - lost) / all_a + caught / all_b, 11) DESC, step LIMIT 1), 0)::DOUBLE AS threshold
)
SELECT page_id, host, path, rule,
       coalesce(ruled, CASE WHEN coalesce(score, 0) >= threshold THEN 'allow' ELSE 'block' END) AS verdict,
       CASE WHEN rule IS NULL THEN CAST(round(CAST(score AS DECIMAL(38, 12)), 6) AS DOUBLE) END AS score, threshold
FROM fitted f LEFT JOIN scored s ON f.text = s.text, limits
"""


ORACLE = _oracle()
