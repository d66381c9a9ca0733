"""Mixing sources to target weights along a curriculum.

Targets: a budget of words is shared among the sources by weight; no target is above
``MAX_EPOCHS`` times its source's size, the excess goes to the others by weight until
none is above (water filling).

Order: each source has a weight schedule over training time 0..1, here linear: a
source's demand for words at time t is proportional to ``1 + slope * (2 t - 1)``.
Integrated, the demand up to t is ``target * (t + slope * (t * t - t))``. Documents of
a source stand in hash order; the words before a copy of a document are its place in
the source's stream, and the time at which the demand reaches that place is the copy's
training position. Copies are then range-sorted by position.

A copy is taken if its middle word lies within the target, so a source's taken words
are within half a document of its target, and no document is taken more than
``MAX_EPOCHS`` times.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import text_key
from tidemark.operators.ranking import numbered
from tidemark.sources import stored

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_EPOCHS = 2
# Early sources fade and late ones grow: slopes by rank of the source, repeating.
SLOPES = (-0.5, 0.0, 0.5)
# A source's stream is summed in buckets by so many hex digits of the hash, 4096 for 3,
# so a hot source is no single task.
BUCKET_DIGITS = 3
# Sources, in bits, whose running sums are one task's; a source may be a host.
BLOCK_BITS = 16


def size_of(text: str = "text") -> Column:
    """Number of words, runs of characters other than blank, tab, LF, VT, FF and CR."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def _cycle(values: tuple, rank: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (F.pmod(rank, F.lit(len(values))) + 1).cast("int"))


def _with_sums_before(rows: DataFrame, place: str, names: list[str]) -> DataFrame:
    """Add ``before_<name>``: the sum of a column over all rows of smaller ``place`` (0, 1, 2, ...).

    Sums run inside blocks of ``2^BLOCK_BITS`` places, and over one short row per block.
    """

    def before(name: str, window) -> Column:
        return F.coalesce(F.sum(name).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    cut = rows.withColumn("block", F.shiftright(place, BLOCK_BITS))
    blocks = cut.groupBy("block").agg(*[F.sum(name).alias(name) for name in names])
    ahead = blocks.select("block", *[before(name, Window.orderBy("block")).alias(f"ahead_{name}") for name in names])
    inside = Window.partitionBy("block").orderBy(place)
    sums = [(before(name, inside) + F.col(f"ahead_{name}")).alias(f"before_{name}") for name in names]
    return cut.join(ahead, "block").select(*rows.columns, *sums)


def targets(sizes: DataFrame, weights=WEIGHTS, share=SHARE, max_epochs=MAX_EPOCHS, slopes=SLOPES) -> DataFrame:
    """(source, source_size, target, slope), one row per source.

    ``sizes`` has ``source`` and ``source_size``. Sources rank by code point, null
    last. The capped sources are those with the least room for their weight, so
    one sort finds the water level: going by size over weight, a source is capped
    while the level at it, budget left over weight left, is at least its own limit.
    Both orders are range sorts, and no task runs over all sources. Starts jobs.
    """
    rank = numbered(sizes.select("source", "source_size"), [F.col("source").isNull(), F.encode("source", "UTF-8")], "rank")
    ranked = rank.select(
        "source",
        "source_size",
        _cycle(weights, F.col("rank")).alias("w"),
        _cycle(slopes, F.col("rank")).alias("slope"),
        # Integers times max_epochs and weights keep every sum exact.
        (F.col("source_size") * F.lit(max_epochs)).alias("limit"),
    )
    placed = numbered(ranked, [F.col("source_size") / F.col("w"), F.col("source").isNull(), F.col("source")], "place")
    budget, weight = placed.agg(F.sum("source_size")).scalar() * F.lit(share), placed.agg(F.sum("w")).scalar()
    level = _with_sums_before(placed, "place", ["limit", "w"]).select(
        "*", (budget - F.col("before_limit")).alias("left"), (weight - F.col("before_w")).alias("weight")
    )
    capped = F.col("limit") * F.col("weight") <= F.col("left") * F.col("w")
    marked = stored(level.withColumn("capped", capped), "mix-levels")
    # The first source that is not capped sets the level of all that follow it; what
    # is left after a source with more room than the level is a lower one.
    rate = marked.filter(~F.col("capped")).agg(F.max(F.col("left") / F.col("weight"))).scalar()
    target = F.when(F.col("capped"), F.col("limit").cast("double")).otherwise(rate * F.col("w"))
    return marked.select("source", "source_size", target.cast("double").alias("target"), "slope")


def position(place: Column, target: Column, slope: Column) -> Column:
    """Time in 0..1 at which the demand of a source reaches ``place`` words."""
    part = F.least(F.greatest(F.when(target > 0, place / target).otherwise(0.0), F.lit(0.0)), F.lit(1.0))
    # slope t^2 + (1 - slope) t = part, solved without cancellation.
    straight = 1 - slope
    root = F.sqrt(straight * straight + 4 * slope * part)
    return F.when(part == 0, 0.0).otherwise(2 * part / (straight + root))


def sized(docs: DataFrame, keep: Column) -> DataFrame:
    """source, key (it, never null), size, the hash that orders its stream, text_key, bucket, and ``keep`` as ``row``."""
    h = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    return docs.select(
        F.col("source"),
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("key"),
        size_of().alias("size"),
        F.unhex(h).alias("h"),
        text_key().alias("text_key"),
        keep.alias("row"),
        F.substring(h, 1, BUCKET_DIGITS).alias("bucket"),
    )


def cells_of(sized: DataFrame) -> DataFrame:
    """(source, key, bucket, words) of :func:`sized` documents, stored."""
    return stored(sized.groupBy("source", "key", "bucket").agg(F.sum("size").alias("words")), "mix-cells")


def mixed(
    sized: DataFrame,
    weights=WEIGHTS,
    share=SHARE,
    max_epochs=MAX_EPOCHS,
    slopes=SLOPES,
    cells: DataFrame | None = None,
    reached: bool = False,
) -> DataFrame:
    """One row per row of :func:`sized` documents: ``row`` and what the mix does with it.

    Columns: row, size, source_size, target, taken, positions (array of training positions,
    one per copy), and mark, a digest of source, id, text and the words before it in its
    source's stream. ``cells`` are those of the same rows, if they are counted already;
    ``reached`` leaves out rows of buckets that begin beyond the target, which have no
    copy. Null texts have size 0.
    Rows without words take no part in the budget; they count as one copy if the
    place they stand at is within the target. Rows that agree in id and text share
    a place at random only in which of them comes first; their columns here agree. An
    empty table gives an empty one.
    """
    cells = cells_of(sized) if cells is None else cells
    plan = targets(cells.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, max_epochs, slopes)
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.withColumn("before", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
    offsets = offsets.join(plan, offsets["source"].eqNullSafe(plan["source"])).select(
        "key", "bucket", "before", "source_size", "target", "slope"
    )
    offsets = stored(offsets, "mix-offsets")
    if reached:
        offsets = offsets.filter(F.col("before") <= F.col("target"))
        sized = sized.join(offsets, ["key", "bucket"], "left_semi")
    # The join has the keys of the window, so that rows are not shuffled again for it.
    inside = Window.partitionBy("key", "bucket").orderBy("h", "text_key").rowsBetween(Window.unboundedPreceding, -1)
    joined = sized.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(offsets, ["key", "bucket"])
    start = F.col("before") + F.col("inside")
    copies = F.sequence(F.lit(0), F.lit(max_epochs - 1))
    places = F.transform(copies, lambda k: start + k * F.col("source_size"))
    taken = F.filter(places, lambda p: p + F.col("size") / 2 <= F.col("target"))
    positions = F.transform(taken, lambda p: position(p + F.col("size") / 2, F.col("target"), F.col("slope")))
    return joined.select(
        "row", "size", "source_size", "target",
        (F.size(taken) * F.col("size")).cast("bigint").alias("taken"), positions.alias("positions"),
        F.unhex(F.md5(F.concat_ws("/", "key", F.hex("h"), "text_key", start).cast("binary"))).alias("mark"),
    )


def plan_of(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, size, source_size, target, taken, first_position) of every document; see :func:`mixed`."""
    # Words are counted once; texts go no further.
    narrow = stored(sized(docs, F.struct("doc_id")), "mix-sizes")
    found = mixed(narrow, **options)
    return found.select(
        F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target", "taken",
        F.round(F.try_element_at("positions", F.lit(1)), 9).alias("first_position"),
    )


def in_order(sized: DataFrame, **options) -> DataFrame:
    """(row, at, mark) of every copy taken, range-sorted by position; see :func:`mixed`."""
    copies = mixed(sized, reached=True, **options).select("row", F.explode("positions").alias("at"), "mark")
    return copies.orderBy("at", F.xxhash64(F.col("row.doc_id"), F.col("row.text")))


def training_order(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, all columns, once per copy taken, range-sorted by position; see :func:`mixed`."""
    return in_order(sized(docs, F.struct("*")), **options).select("row.*")


def accounts(docs: DataFrame, **options) -> DataFrame:
    """The columns of :func:`plan_of`, with ``taken`` and ``first_position`` from the mix itself.

    The copies are put in training order, whole rows with their texts, and their words
    counted there; the first of a document's copies in that order gives its position.
    Only rows without words can share a mark; they are told alike.
    """
    # Words of the documents are counted once for the plan, and again in the copies.
    narrow = stored(sized(docs, F.struct("doc_id")), "mix-sizes")
    cells = cells_of(narrow)
    turn = F.monotonically_increasing_id().alias("turn")
    copies = in_order(sized(docs, F.struct("*")), cells=cells, **options)
    copies = copies.select("mark", "at", size_of("row.text").alias("words"), turn)
    met = copies.groupBy("mark").agg(F.sum("words").alias("words"), F.min_by("at", "turn").alias("first"))
    plan = mixed(narrow, cells=cells, **options)
    return plan.join(met, "mark", "left").select(
        F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target",
        F.coalesce("words", F.lit(0)).cast("bigint").alias("taken"), F.round("first", 9).alias("first_position"),
    )


# One round of the cap is settled per source that is capped, in the order of room per weight.
ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, md5(CAST(doc_id AS VARCHAR)) AS h,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents
), sizes AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1 AS rank
  FROM sized GROUP BY source
), ranked AS (
  SELECT source, source_size, source_size * 2 AS cap,
         CASE rank % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w,
         CASE rank % 3 WHEN 0 THEN -0.5::DOUBLE WHEN 1 THEN 0.0::DOUBLE ELSE 0.5::DOUBLE END AS slope
  FROM sizes
), level AS (
  SELECT *, CAST(sum(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE
            - CAST(coalesce(sum(cap) OVER before, 0) AS DOUBLE) AS rest,
         CAST(sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS DOUBLE) AS weight
  FROM ranked
  WINDOW before AS (ORDER BY CAST(source_size AS DOUBLE) / w, source IS NULL, source
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), marked AS (SELECT *, cap * weight <= rest * w AS capped FROM level
), plan AS (
  SELECT source, source_size, slope,
         CASE WHEN capped THEN CAST(cap AS DOUBLE)
              ELSE (SELECT max(rest / weight) FROM marked WHERE NOT capped) * w END AS target
  FROM marked
), placed AS (
  SELECT s.doc_id, s.size, p.source_size, p.target, p.slope,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.h
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source
), parts AS (
  SELECT *, CAST(start + size / 2.0::DOUBLE <= target AS BIGINT)
            + CAST(start + source_size + size / 2.0::DOUBLE <= target AS BIGINT) AS copies,
         least(greatest(CASE WHEN target > 0 THEN (start + size / 2.0::DOUBLE) / target ELSE 0 END, 0), 1) AS part
  FROM placed
)
SELECT doc_id, size, source_size, target, copies * size AS taken,
       CASE WHEN copies = 0 THEN NULL WHEN part = 0 THEN 0.0::DOUBLE
            ELSE round(2 * part / (1 - slope + sqrt((1 - slope) * (1 - slope) + 4 * slope * part)), 9)
       END AS first_position
FROM parts
"""
