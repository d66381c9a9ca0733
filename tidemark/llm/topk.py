"""Exact top-k search by inner product over a pivot-distance index.

Vectors get one more component that brings all of them to one length; then the largest
inner product is the smallest distance. Every vector is keyed by its nearest pivot and
its distance to it. In that order vectors are cut into annuli of at most
``ANNULUS`` rows, stored with their least and largest distance.

By the triangle inequality a vector x of the annulus [lo, hi] round pivot p is at least
``max(d(q, p) - hi, lo - d(q, p))`` from query q. Queries come in chunks of near
ones. A chunk first searches the annulus round its pivot that is nearest to it, which
gives every query a bound, the distance of its k-th best so far. The annuli that the
bounds do not rule out are dealt to visits of at most ``VISIT``. A visit expands
from the nearest annulus outwards: each one that is searched tightens the bounds, and a
query stops at annuli beyond its own. Scores are integers, so they are exact.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from tidemark.sources import stored

K = 20
SCALE = 64
EVERY = 20
PIVOTS = 64
# Pivots are picked from the so many vectors whose ids have the smallest hash.
PIVOT_SAMPLE = 4096
ANNULUS = 4096
CHUNK = 1024
# Annuli that a task visits one after another for a chunk of queries.
VISIT = 32
# Whole numbers up to here are exact in floats and doubles, so a product may use them.
EXACT_FLOAT, EXACT_DOUBLE = 1 << 24, 1 << 53
# Scores from here on do not fit into 64 bits.
FULL = 2.0**63


def quantised(column: str = "embedding", scale: int = SCALE) -> Column:
    """floor(scale * x) of each component, x as double; null if the vector takes no part.

    A component that does not fit into 64 bits then is an error.
    """
    vector = F.col(column)
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))

    def whole_number(x: Column) -> Column:
        scaled = F.lit(float(scale)) * x.cast("double")
        # Beyond 64 bits, floor() would give the largest number there is.
        return F.when(F.abs(scaled) < 2.0**63, F.floor(scaled)).otherwise(
            F.raise_error(F.concat(F.lit("component too large for 64 bits: "), x.cast("string")))
        ).cast("bigint")

    whole = F.transform(vector, whole_number)
    return F.when(F.coalesce(good, F.lit(False)), whole)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """(rows, width) of whole numbers, shorter vectors filled with 0."""
    lists = column.flatten().to_numpy(zero_copy_only=False)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return lists.reshape(-1, width)
    out = np.zeros((len(sizes), width), np.int64)
    ends = np.cumsum(sizes)
    for row, (end, size) in enumerate(zip(ends.tolist(), sizes.tolist(), strict=True)):
        out[row, :size] = lists[end - size : end]
    return out


def _dense(rows: np.ndarray) -> bytes:
    """Whole numbers in the fewest bytes that hold all of them."""
    most = int(np.abs(rows).max(initial=0))
    size = next((size for size in (1, 2, 4) if most < 1 << (8 * size - 1)), 8)
    return rows.astype(f"<i{size}").tobytes()


def _undense(data: pa.Scalar, rows: int, width: int) -> np.ndarray:
    raw = data.as_buffer()
    return np.frombuffer(raw, f"<i{raw.size // max(rows * width, 1)}").reshape(rows, width)


def _distances(rows: np.ndarray, pivots: np.ndarray, longest: float, lift: bool) -> np.ndarray:
    """(rows, pivots) distances after lifting; a query's added component is 0."""
    squares = np.einsum("ij,ij->i", rows, rows)
    lifted = np.sqrt(np.maximum(longest - squares, 0)) if lift else np.zeros(len(rows))
    flat, last = pivots[:, :-1], pivots[:, -1]
    total = (squares + lifted**2)[:, None] + np.einsum("ij,ij->i", pivots, pivots)[None, :]
    return np.sqrt(np.maximum(total - 2 * (rows @ flat.T + lifted[:, None] * last[None, :]), 0))


def choose_pivots(vectors: DataFrame, width: int, longest: float, count: int, sample: int) -> np.ndarray:
    """Up to ``count`` lifted vectors of a bounded sample, each the farthest from those before it."""
    chosen = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("v").toArrow()
    rows = _matrix(chosen["v"].combine_chunks(), width).astype(np.float64)
    rows = np.hstack([rows, np.sqrt(np.maximum(longest - np.einsum("ij,ij->i", rows, rows), 0))[:, None]])
    rows = np.unique(rows, axis=0)
    picked, away = [0], np.full(len(rows), np.inf)
    while len(picked) < min(count, len(rows)):
        away = np.minimum(away, np.linalg.norm(rows - rows[picked[-1]], axis=1))
        picked.append(int(away.argmax()))
    return rows[picked]


def _keyed(vectors: DataFrame, pivots: np.ndarray, width: int, longest: float, lift: bool) -> DataFrame:
    """vec_id, v, pivot and distance: the nearest pivot of each vector."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _matrix(batch.column("v"), width).astype(np.float64)
            away = _distances(rows, pivots, longest, lift)
            near = away.argmin(1)
            found = [pa.array(near.astype(np.int32)), pa.array(away[np.arange(len(near)), near])]
            yield pa.RecordBatch.from_arrays([*batch.columns, *found], ["vec_id", "v", "pivot", "distance"])

    more = [StructField("pivot", IntegerType()), StructField("distance", DoubleType())]
    return vectors.select("vec_id", "v").mapInArrow(run, StructType([*vectors.select("vec_id", "v").schema, *more]))


def _blocks(keyed: DataFrame, rows: int, width: int) -> DataFrame:
    """Vectors in (pivot, distance) order in blocks of at most ``rows`` rows.

    A range sort deals rows of one pivot to many tasks, so a hot pivot is no single
    task. Columns: block, pivot, lo, hi, ids as an array, vectors as bytes.
    """
    ordered = keyed.repartitionByRange("pivot", "distance", "vec_id").sortWithinPartitions("pivot", "distance", "vec_id")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def close() -> pa.RecordBatch:
            whole = pa.Table.from_batches(held).combine_chunks()
            away = whole["distance"].to_numpy()
            ids = whole["vec_id"].combine_chunks()
            flat = _dense(_matrix(whole["v"].combine_chunks(), width))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([whole["pivot"][0].as_py()], pa.int32()),
                    pa.array([away.min()]),
                    pa.array([away.max()]),
                    pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                    pa.array([flat], pa.binary()),
                ],
                ["pivot", "lo", "hi", "ids", "vectors"],
            )

        size, pivot = 0, None
        for batch in batches:
            keys = batch.column("pivot").to_numpy()
            start = 0
            while start < len(keys):
                if held and (keys[start] != pivot or size == rows):
                    yield close()
                    held, size = [], 0
                pivot = keys[start]
                same = int(np.searchsorted(keys, pivot, side="right"))
                end = min(same, start + rows - size)
                held.append(batch.slice(start, end - start))
                size, start = size + end - start, end
        if held:
            yield close()

    kind = keyed.schema["vec_id"].dataType.simpleString()
    schema = f"pivot int, lo double, hi double, ids array<{kind}>, vectors binary"
    return ordered.mapInArrow(run, schema).withColumn("block", F.monotonically_increasing_id())


def _refuse_overflow(left: np.ndarray, right: np.ndarray, own: np.ndarray) -> None:
    """Sums of 64-bit products are right if the result fits, whatever happens on the way."""
    score = left.astype(np.float64) @ right.astype(np.float64).T
    if (np.abs(score[~own]) > FULL * (1 - 1e-9)).any():
        raise OverflowError("an inner product does not fit into 64 bits")


class Expansion:
    """The ``k`` best of each query over blocks that come one after another.

    ``bounds`` and ``last`` are score and vec_id of a query's k-th best known before,
    ``bound`` is false where there is none: what ranks behind is not looked for. Each
    block tightens the bound of the queries that it has better vectors for; a query
    skips a block that the triangle inequality puts beyond its bound.
    """

    def __init__(self, q_ids: np.ndarray, left: np.ndarray, bounds: np.ndarray, last: np.ndarray, bound: np.ndarray, k: int):
        self.q_ids, self.left, self.k = q_ids, left, k
        self.bounds, self.last, self.bound = bounds.copy(), last.copy(), bound.copy()
        self.best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.compared = 0

    def radii(self, longest: float) -> np.ndarray:
        """Distance of each query's k-th best; d^2 = q^2 + longest - 2 score."""
        rows = self.left.astype(np.float64)
        radius = np.sqrt(np.maximum(np.einsum("ij,ij->i", rows, rows) + longest - 2 * self.bounds.astype(np.float64), 0))
        # A little more than rounding can take away.
        return np.where(self.bound, radius * (1 + 1e-9) + 1e-6 * np.sqrt(longest + 1), np.inf)

    def visit(self, ids: np.ndarray, right: np.ndarray, wanted: np.ndarray | None = None) -> None:
        """Compare the queries, or the ``wanted`` ones, with a block; ids ascend."""
        wanted = np.arange(len(self.q_ids)) if wanted is None else wanted
        if not len(wanted):
            return
        self.compared += 1
        most = float(np.abs(self.left.astype(np.float64)).max(initial=0)) * float(np.abs(right.astype(np.float64)).max(initial=0)) * right.shape[1]
        kind = np.float32 if most < EXACT_FLOAT else np.float64 if most < EXACT_DOUBLE else np.int64
        block = right.astype(kind)
        for first in range(0, len(wanted), 256):
            rows = wanted[first : first + 256]
            own = ids[None, :] == self.q_ids[rows][:, None]
            if most >= FULL:
                _refuse_overflow(self.left[rows], right, own)
            score = self.left[rows].astype(kind) @ block.T
            # A bound that this kind rounds is above all scores that it is used for.
            limit, bound = self.bounds[rows].astype(kind)[:, None], self.bound[rows][:, None]
            keep = ~own & (~bound | (score >= limit))
            # Most blocks hold no tie, so ids are compared only where one is.
            ties = np.flatnonzero((bound & keep & (score == limit)).any(1))
            keep[ties] &= (score[ties] > limit[ties]) | (ids[None, :] <= self.last[rows[ties]][:, None])
            for at in np.flatnonzero(keep.any(1)).tolist():
                spot = np.flatnonzero(keep[at])
                # Ids ascend, so a stable sort leaves ties in their order.
                spot = spot[np.argsort(-score[at, spot], kind="stable")[: self.k]]
                self._merge(int(rows[at]), score[at, spot].astype(np.int64), ids[spot])

    def _merge(self, row: int, score: np.ndarray, ids: np.ndarray) -> None:
        if row in self.best:
            score, ids = (np.concatenate(pair) for pair in zip(self.best[row], (score, ids), strict=True))
            order = np.lexsort((ids, -score))[: self.k]
            score, ids = score[order], ids[order]
        self.best[row] = score, ids
        if len(ids) == self.k:
            self.bounds[row], self.last[row], self.bound[row] = score[-1], ids[-1], True

    def found(self, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
        """(query_id, vec_id, score) of all queries, so many at a time."""
        rows = list(self.best)
        for first in range(0, len(rows), 512):
            some = rows[first : first + 512]
            queries = np.repeat(self.q_ids[some], [len(self.best[row][1]) for row in some])
            ids, scores = (np.concatenate([self.best[row][part] for row in some]) for part in (1, 0))
            yield pa.RecordBatch.from_arrays(
                [pa.array(queries, kind), pa.array(ids, kind), pa.array(scores)], ["query_id", "vec_id", "score"]
            )


def _search(pairs: DataFrame, k: int, width: int, centres: np.ndarray, longest: float) -> DataFrame:
    """(query_id, vec_id, score): the k best of each query in the blocks of each visit.

    ``pairs`` has visit, q_ids, q_vectors, bounds and last (score and vec_id of a query's
    k-th best so far, null if there is none), pivot, lo, hi, ids and vectors. Rows of a
    visit follow one another, near blocks first. Ties go to smaller vec_id. A score
    beyond 64 bits is an error.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        visit, search, away = None, None, None
        for batch in batches:
            for at in range(batch.num_rows):
                kind = batch.column("ids").type.value_type
                if search is None or batch.column("visit")[at].as_py() != visit:
                    if search is not None:
                        yield from search.found(kind)
                    visit = batch.column("visit")[at].as_py()
                    q_ids = batch.column("q_ids")[at].values.to_numpy()
                    left = _undense(batch.column("q_vectors")[at], len(q_ids), width)
                    bounds, last = (batch.column(name)[at].values for name in ("bounds", "last"))
                    bound = bounds.is_valid().to_numpy(zero_copy_only=False)
                    search = Expansion(
                        q_ids, left, pc.fill_null(bounds, 0).to_numpy(), np.where(bound, last.to_pandas(), q_ids), bound, k
                    )
                    away = _distances(left.astype(np.float64), centres, longest, False)
                ids = batch.column("ids")[at].values.to_numpy()
                pivot, lo, hi = (batch.column(name)[at].as_py() for name in ("pivot", "lo", "hi"))
                nearest = np.maximum(away[:, pivot] - hi, lo - away[:, pivot])
                wanted = np.flatnonzero(nearest <= search.radii(longest))
                order = np.argsort(ids, kind="stable")
                search.visit(ids[order], _undense(batch.column("vectors")[at], len(ids), width)[order], wanted)
        if search is not None:
            yield from search.found(kind)

    kind = pairs.schema["ids"].dataType.elementType.simpleString()
    chosen = pairs.select("visit", "q_ids", "q_vectors", "bounds", "last", "pivot", "lo", "hi", "ids", "vectors")
    return chosen.mapInArrow(run, f"query_id {kind}, vec_id {kind}, score bigint")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _single(vectors: DataFrame) -> DataFrame:
    """One vector for each id, in no order."""
    return vectors.filter("vec_id is not null and v is not null").groupBy("vec_id").agg(F.max("v").alias("v"))


def search(vectors: DataFrame, queries: DataFrame, k: int = K, pivots: int = PIVOTS, sample: int = PIVOT_SAMPLE,
           annulus: int = ANNULUS, chunk: int = CHUNK) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest inner products of each query.

    Both tables have ``vec_id`` and ``v``, an array of whole numbers or null; null ids
    and vectors take no part, an id that repeats counts once, with its largest vector,
    and a query is not its own result. Vectors of different lengths are compared as if filled with zeros. No
    vectors, or none but the query, give no rows.
    """
    vectors, queries = stored(_single(vectors), "vectors"), stored(_single(queries), "queries")
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    width, longest = vectors.agg(F.max(F.size("v")), F.max(square)).first()
    kind = vectors.schema["vec_id"].dataType.simpleString()
    if not width:
        return vectors.sparkSession.createDataFrame([], f"query_id {kind}, rank int, vec_id {kind}, score bigint")
    widest = queries.agg(F.max(F.size("v"))).first()[0] or 0
    width = max(width, widest)
    centres = choose_pivots(vectors, width, longest, pivots, sample)
    index = stored(_blocks(_keyed(vectors, centres, width, longest, True), annulus, width), "annuli")
    asked = stored(_blocks(_keyed(queries, centres, width, longest, False), chunk, width), "query-chunks")
    chunks = asked.select(F.col("block").alias("chunk"), F.col("pivot").alias("home"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"))

    # First round: the annulus round a chunk's home pivot that lies nearest to its queries. A
    # chunk whose home has none starts without bounds and so meets all annuli.
    spans = index.select("block", "pivot", "lo", "hi")
    homes = asked.select(F.col("block").alias("chunk"), "pivot", F.col("lo").alias("q_lo"), F.col("hi").alias("q_hi"))
    gap = F.greatest(F.col("lo") - F.col("q_hi"), F.col("q_lo") - F.col("hi"), F.lit(0.0))
    near = homes.join(spans, "pivot").groupBy("chunk").agg(F.min(F.struct(gap.alias("gap"), "block")).alias("n"))
    first = stored(near.select("chunk", F.col("n.block").alias("block")), "first-pairs")
    no_bound = F.transform("q_ids", lambda _: F.lit(None).cast("bigint")).alias("bounds")
    no_last = F.transform("q_ids", lambda _: F.lit(None).cast(kind)).alias("last")
    pairs = chunks.select(F.col("chunk").cast("string").alias("visit"), "chunk", "q_ids", "q_vectors", no_bound, no_last)
    pairs = pairs.join(first, "chunk").join(index, "block")
    found = stored(_best(_search(pairs, k, width, centres, longest), k), "first-found")

    # Second round, from the k-th score so far.
    kth = found.filter(F.col("rank") == k).select("query_id", F.col("score").alias("least"), F.col("vec_id").alias("last"))

    def reach(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                least = batch.column("bounds")[at].values
                rows = _undense(batch.column("q_vectors")[at], len(least), width)
                bound = least.is_valid().to_numpy(zero_copy_only=False)
                bounds = pc.fill_null(least, 0).to_numpy()
                radius = Expansion(bounds, rows, bounds, bounds, bound, k).radii(longest)
                away = _distances(rows.astype(np.float64), centres, longest, False)
                size = len(centres)
                columns = [(away - radius[:, None]).min(0), (away + radius[:, None]).max(0), away.min(0), away.max(0)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([batch.column("chunk")[at].as_py()] * size, pa.int64()),
                        pa.array(np.arange(size), pa.int32()),
                        *map(pa.array, columns),
                    ],
                    ["chunk", "pivot", "from", "to", "nearest", "farthest"],
                )

    members = chunks.select("chunk", F.posexplode("q_ids").alias("pos", "query_id"))
    ordered = F.array_sort(F.collect_list(F.struct("pos", "least", "last")))
    limits = members.join(kth, "query_id", "left").groupBy("chunk").agg(
        F.transform(ordered, lambda x: x["least"]).alias("bounds"), F.transform(ordered, lambda x: x["last"]).alias("last")
    )
    bounded = stored(chunks.join(limits, "chunk"), "bounded-chunks")
    ranges = bounded.select("chunk", "q_vectors", "bounds").mapInArrow(
        reach, "chunk bigint, pivot int, `from` double, `to` double, nearest double, farthest double"
    )
    # An annulus is wanted if its distances meet the interval of any query of the chunk.
    wanted = ranges.join(spans, "pivot").filter((F.col("lo") <= F.col("to")) & (F.col("hi") >= F.col("from")))
    gap = F.greatest(F.col("nearest") - F.col("hi"), F.col("lo") - F.col("farthest"), F.lit(0.0)).alias("gap")
    wanted = wanted.select("chunk", "block", gap).join(first, ["chunk", "block"], "left_anti")
    # Visits of at most VISIT annuli each, every one with near and far ones: a short row per pair.
    order = Window.partitionBy("chunk").orderBy("gap", "block")
    parts = F.ceil(F.count(F.lit(1)).over(Window.partitionBy("chunk")) / VISIT)
    dealt = wanted.select("*", F.pmod(F.row_number().over(order), parts).alias("part"))
    dealt = dealt.select("chunk", "block", "gap", F.concat_ws(":", "chunk", "part").alias("visit"))
    pairs = stored(dealt, "visits").join(bounded, "chunk").join(index, "block")
    visits = pairs.repartition("visit").sortWithinPartitions("visit", "gap", "block")
    best = _best(found.drop("rank").unionByName(_search(visits, k, width, centres, longest)), k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def every(embeddings: DataFrame, each: int = EVERY, k: int = K, **options) -> DataFrame:
    """The search of every ``each``-th vec_id against all other rows, by quantised vectors."""
    vectors = embeddings.select("vec_id", quantised().alias("v"))
    return search(vectors, vectors.filter(F.col("vec_id") % each == 0), k, **options)


# All pairs, as SQL has no index to prune them with.
ORACLE = f"""
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id % {EVERY} = 0 AND q.vec_id <> c.vec_id
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {K}
"""
