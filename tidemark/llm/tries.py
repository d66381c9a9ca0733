"""How five filters interact, with exact duplicates found by radix tries over whole texts.

A text's failures are a mask of five bits. Four follow from the text alone; the fifth,
a copy under a smaller id, is found by compressed tries:

1. Each task inserts the texts it reads into a trie whose terminals hold the smallest
   id. A row that meets a smaller id of the same text is settled at once and its text
   goes no further, so a text that a third of all rows hold leaves a task once.
2. The texts left are range-partitioned and sorted by their leading bytes, then by
   hashes of ever longer prefixes up to the whole text. Spark draws the bounds from a
   sample of these short keys, so a bound reaches as deep into the prefixes as common
   beginnings make it, and a common beginning is spread over many tasks.
3. Each partition inserts its texts into a trie again; a traversal gives the flags. Equal
   texts are neighbours, so a trie that has grown to ``HELD_BYTES`` is traversed and let
   go wherever the text changes: memory doesn't grow with the partition.

Masks are counted by part, at most 32 rows each, and the counts meet a table of all
orders and steps.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import slices
from tidemark.sources import stored

FILTERS = "ABCDE"
A, B, C, D, E = (1 << k for k in range(5))
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 100, 80, 10
# Bytes that a trie holds after which it is traversed and let go, and those of a node beside its label.
HELD_BYTES, NODE_BYTES = 32 << 20, 512
# Bytes of the leading range key, and lengths of the prefixes hashed after it.
LEAD, DEEPER = 8, (64, 512)

_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
# Bytes that go on with a character.
_INSIDE = bytes(range(0x80, 0xC0))
_MARKS = b"#$%&*|"


def text_mask(text: bytes) -> int:
    """The failures of a text by itself: A, B, C and D."""
    # With no argument, bytes are split at blanks and \x09 to \x0d.
    words = text.split()
    points = len(text.translate(None, _INSIDE))
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    mask = A if len(words) < LEAST_WORDS else 0
    mask |= B if 100 * len(set(words)) < LEAST_DISTINCT * len(words) else 0
    mask |= C if 100 * capitals > MOST_CAPITALS * points else 0
    return mask | (D if len(text.translate(None, _MARKS)) < len(text) else 0)


class Node:
    """The bytes that lead here from the node above, the nodes below, and a terminal's rows."""

    __slots__ = ("label", "below", "least", "mask", "rows")

    def __init__(self, label: bytes):
        self.label, self.below = label, {}
        # Smallest id of the text that ends here, and the rows per part that have it.
        self.least, self.mask, self.rows = None, 0, None


def _common(label: bytes, text: bytes, at: int) -> int:
    """How many bytes of the label agree with the text from ``at`` on, at least one."""
    low, high = 1, min(len(label), len(text) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if text.startswith(label[low:middle], at + low):
            low = middle
        else:
            high = middle - 1
    return low


class Trie:
    """A compressed trie of whole texts; terminals hold the smallest id."""

    def __init__(self):
        self.root, self.held = Node(b""), 0

    def terminal(self, text: bytes) -> Node:
        """The node where a text ends; its missing bytes are added."""
        node, at = self.root, 0
        while at < len(text):
            edge = node.below.get(text[at])
            if edge is None:
                edge = node.below[text[at]] = Node(text[at:])
                self.held += len(edge.label) + NODE_BYTES
            elif not text.startswith(edge.label, at):
                size = _common(edge.label, text, at)
                upper = node.below[text[at]] = Node(edge.label[:size])
                edge.label = edge.label[size:]
                self.held += NODE_BYTES
                upper.below[edge.label[0]] = edge
                edge = upper
            node, at = edge, at + len(edge.label)
        return node

    def add(self, doc_id, part: str, mask: int, n: int, text: bytes) -> Iterator[tuple]:
        """Insert rows of one text; (id, part, mask) and count of rows this settles as copies."""
        node = self.terminal(text)
        if node.least is not None and doc_id > node.least:
            yield doc_id, part, mask | E, n
            return
        if node.least is None or doc_id < node.least:
            for other, count in (node.rows or {}).items():
                yield node.least, other, node.mask | E, count
            node.least, node.mask, node.rows = doc_id, mask, {}
        node.rows[part] = node.rows.get(part, 0) + n

    def traverse(self) -> Iterator[tuple]:
        """(id, part, mask, count, text) of the rows with the smallest id, text by text."""
        stack = [(self.root, b"")]
        while stack:
            node, text = stack.pop()
            for part, count in (node.rows or {}).items():
                yield node.least, part, node.mask, count, text
            stack.extend((below, text + below.label) for below in node.below.values())


class _Rows:
    """Rows gathered into Arrow batches of bounded size."""

    def __init__(self, kind: pa.DataType, with_text: bool):
        fields = [("doc_id", kind), ("part", pa.string()), ("mask", pa.int32()), ("n", pa.int64()), ("text", pa.binary())]
        self.schema = pa.schema(fields if with_text else fields[:-1])
        self.rows, self.size = [], 0

    def put(self, *row) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.size += 64 + (len(row[4]) if len(row) > 4 and row[4] else 0)
        if self.size > HELD_BYTES // 8:
            yield from self.close()

    def close(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            columns = zip(*self.rows, strict=True)
            arrays = [pa.array(column, field.type) for column, field in zip(columns, self.schema, strict=True)]
            self.rows, self.size = [], 0
            yield pa.RecordBatch.from_arrays(arrays, schema=self.schema)


def _local(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Masks of all rows; texts only where a smaller id may still be found elsewhere."""
    trie, out = Trie(), None
    for batch in slices(batches):
        out = out or _Rows(batch.column("doc_id").type, True)
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        for doc_id, part, text in zip(batch.column("doc_id").to_pylist(), batch.column("part").to_pylist(), texts, strict=True):
            mask = text_mask(text or b"")
            if doc_id is None:
                yield from out.put(None, part, mask, 1, None)
                continue
            for settled in trie.add(doc_id, part, mask, 1, text or b""):
                yield from out.put(*settled, None)
            if trie.held > HELD_BYTES:
                for row in trie.traverse():
                    yield from out.put(*row)
                trie = Trie()
    if out:
        for row in trie.traverse():
            yield from out.put(*row)
        yield from out.close()


def _settle(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Masks of sorted rows, all failures told; rows of equal texts follow one another."""
    trie, out, last = Trie(), None, None
    for batch in slices(batches):
        out = out or _Rows(batch.column("doc_id").type, False)
        names = ("doc_id", "part", "mask", "n", "text", "whole")
        for *row, whole in zip(*(batch.column(name).to_pylist() for name in names), strict=True):
            if trie.held > HELD_BYTES and whole != last:
                for *least, _ in trie.traverse():
                    yield from out.put(*least)
                trie = Trie()
            last = whole
            for settled in trie.add(*row):
                yield from out.put(*settled)
    if out:
        for *least, _ in trie.traverse():
            yield from out.put(*least)
        yield from out.close()


def masks(docs: DataFrame, part: str = "lang") -> DataFrame:
    """(doc_id, part, mask, n): how many rows of an id and part fail the filters in ``mask``.

    Null texts count as empty, and empty texts are copies of one another; no part is
    the empty string. Rows that repeat share one count: none of them has a smaller id
    than the others. A row without an id fails nothing by E, nor does it make another
    fail. Of rows that share an id, each is judged by its own text. An empty table
    gives an empty one; columns of ``docs`` other than these three aren't read.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    narrow = docs.select("doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), "text")
    found = stored(narrow.mapInArrow(_local, f"doc_id {kind}, part string, mask int, n bigint, text binary"), "trie-rows")
    left = found.filter(F.col("text").isNotNull()).select(
        "*",
        F.substring("text", 1, LEAD).alias("lead"),
        *[F.xxhash64(F.substring("text", 1, length)).alias(f"deep{length}") for length in DEEPER],
        F.xxhash64("text").alias("whole"),
    )
    keys = ["lead", *[f"deep{length}" for length in DEEPER], "whole"]
    ordered = left.repartitionByRange(*keys).sortWithinPartitions(*keys)
    settled = ordered.select("doc_id", "part", "mask", "n", "text", "whole").mapInArrow(
        _settle, f"doc_id {kind}, part string, mask int, n bigint"
    )
    known = found.filter(F.col("text").isNull()).select("doc_id", "part", "mask", "n")
    return known.unionByName(settled)


def steps(spark) -> DataFrame:
    """(filter_order, step, letter, bit, earlier): 600 rows, all orders of the filters and their steps."""
    rows = [
        ("".join(order), k + 1, order[k], 1 << FILTERS.index(order[k]), sum(1 << FILTERS.index(f) for f in order[:k]))
        for order in permutations(FILTERS)
        for k in range(len(FILTERS))
    ]
    return spark.createDataFrame(rows, "filter_order string, step int, letter string, bit int, earlier int")


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """One row per part, order of the filters and step; see :func:`masks` for odd rows.

    kept after the step; removed by it; redundant, failing it but removed before;
    unique_fails, failing it alone; good_lost and toxic_lost, removed here and labelled
    so; shapley, what its filter removes summed over all orders. A label counts if any
    row of its id has it; labels without an id, or of no document, count nothing.
    """
    rows = masks(docs, part).groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n"))
    known = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        *[F.max((F.col(c) == 1).cast("bigint")).alias(c) for c in ("quality", "toxic")]
    )
    labelled = rows.join(known, "doc_id", "left")
    marks = [F.sum(F.col("n") * F.coalesce(c, F.lit(0))).alias(a) for c, a in (("quality", "good"), ("toxic", "bad"))]
    counts = stored(labelled.groupBy("part", "mask").agg(F.sum("n").alias("n"), *marks), "mask-counts")
    # 32 masks by 600 steps: its size doesn't depend on the data.
    every = steps(docs.sparkSession).select("*", F.explode(F.sequence(F.lit(0), F.lit(31))).alias("mask"))
    fails = F.col("mask").bitwiseAND(F.col("bit")) != 0
    gone = F.col("mask").bitwiseAND(F.col("earlier")) != 0

    def total(condition, column: str = "n"):
        return F.sum(F.when(condition, F.col(column)).otherwise(0)).cast("bigint")

    told = counts.join(F.broadcast(every), "mask").groupBy("part", "filter_order", "step", "letter").agg(
        total(~fails & ~gone).alias("kept"),
        total(fails & ~gone).alias("removed"),
        total(fails & gone).alias("redundant"),
        total(F.col("mask") == F.col("bit")).alias("unique_fails"),
        total(fails & ~gone, "good").alias("good_lost"),
        total(fails & ~gone, "bad").alias("toxic_lost"),
    )
    # 120 rows to a window, one per order.
    shapley = F.sum("removed").over(Window.partitionBy("part", "letter")).cast("bigint")
    return told.withColumn("shapley", shapley).drop("letter")


ORACLE = rf"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), fails AS (
  SELECT doc_id, part, len(words) < {LEAST_WORDS} AS a, 100 * len(list_distinct(words)) < {LEAST_DISTINCT} * len(words) AS b,
         100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > {MOST_CAPITALS} * length(text) AS c,
         regexp_matches(text, '[#$%&*|]') AS d,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS e
  FROM texts
), known AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS bad FROM labels GROUP BY doc_id
), masks AS (
  SELECT part, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS mask,
         count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(bad, 0)) AS bad
  FROM fails LEFT JOIN known USING (doc_id) GROUP BY ALL
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l, unnest([1, 2, 4, 8, 16]) AS b
), orders AS (
  SELECT p.l || q.l || r.l || s.l || t.l AS filter_order, [p.b, q.b, r.b, s.b, t.b] AS bits
  FROM letters p, letters q, letters r, letters s, letters t WHERE p.b + q.b + r.b + s.b + t.b = 31
    AND p.b | q.b | r.b | s.b | t.b = 31
), steps AS (
  SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS earlier
  FROM (SELECT filter_order, bits, unnest([1, 2, 3, 4, 5]) AS step FROM orders)
), told AS (
  SELECT part, filter_order, step, bit,
         sum(CASE WHEN mask & (bit | earlier) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN mask & bit <> 0 AND mask & earlier = 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN mask & bit <> 0 AND mask & earlier <> 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN mask & bit <> 0 AND mask & earlier = 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN mask & bit <> 0 AND mask & earlier = 0 THEN bad ELSE 0 END) AS toxic_lost
  FROM masks, steps GROUP BY ALL
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM told
"""
