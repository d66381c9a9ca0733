"""Embedding near-duplicates by a subspace pigeonhole join.

Unit vectors with cosine at least c lie within squared distance ``D = 2 (1 - c)``.
Vectors are rotated and split into subspaces of ``SUBSPACE`` components; if a pair is
within D, some subspace holds at most its share of D. So each subspace is range-joined
under that proportional budget, and the union of what is found is checked exactly.

Vectors lie in groups of bounded size, in k-d order: a tree fitted on a bounded sample
deals all rows into leaves, and a range sort by leaf is cut into groups, so a hot leaf
is many groups. Groups whose boxes are within D are paired, by an equi-join on the
slabs of a component that both touch. A task gets the vectors of a pair once and joins
them in every subspace: it splits both sides at medians of their widest component into
blocks of at most ``BLOCK`` rows, leaves out pairs of blocks whose boxes are further
apart than the budget, and compares the rows of the others.

A pair of vectors that passes in several subspaces counts in the first only. A task
checks its pairs itself and returns counts and a spanning forest, so copies and dense
groups are never expanded into pairs outside it. Equal vectors are one point from the
start. Vectors of different lengths have no cosine: every length has its own rotation,
tree and groups.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.sources import stored

THRESHOLD = 0.95
SUBSPACE = 4
# Components of a group of vectors, and rows of a block inside it.
GROUP, BLOCK = 1 << 20, 64
# Vectors with the smallest hashes that the k-d trees are fitted on, and rows of a leaf among them.
SAMPLE, LEAF = 8192, 32
SEED = 11
# Pairs looked at in one step.
TILE = 1 << 15
# Margin that keeps rounding from losing a pair, in doubles and in floats.
SLACK, LOOSE = 1e-6, 1e-5
# Components that candidates are compared in before whole vectors are.
SOON = 16


@lru_cache(maxsize=8)
def rotation(width: int, seed: int = SEED) -> np.ndarray:
    """A fixed random rotation, so that no subspace is special."""
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(width, width)))
    return q * np.sign(np.diag(r))


def _rows(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy().astype(np.float64).reshape(-1, width)


def usable(embeddings: DataFrame) -> DataFrame:
    """vec_id and x, the vector; x is null where it links with nothing."""
    vector = F.col("embedding")
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    some = F.exists(vector, lambda x: x != 0)
    return embeddings.select("vec_id", F.when(F.coalesce(good & some, F.lit(False)), vector).alias("x"))


def _narrow(x: np.ndarray) -> bytes:
    """Doubles, as floats if they are floats: embeddings mostly are."""
    small = x.astype(np.float32)
    return small.tobytes() if (small == x).all() else x.tobytes()


def _wide(data: pa.Scalar, rows: int, width: int) -> np.ndarray:
    raw = data.as_buffer()
    kind = np.float32 if raw.size == 4 * rows * width else np.float64
    return np.frombuffer(raw, kind).reshape(rows, width).astype(np.float64)


def _units(x: np.ndarray) -> np.ndarray:
    """Unit vectors; scaling by the largest component first keeps squares finite."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _turned(x: np.ndarray) -> np.ndarray:
    """Rotated unit vectors."""
    return _units(x) @ rotation(x.shape[1])


def fit_tree(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(component, cut) of the nodes of a k-d tree, root first; node n has children 2n + 1 and 2n + 2."""
    depth = max(0, int(np.log2(max(1, len(y) // LEAF))))
    part, cut = np.zeros((1 << depth) - 1, np.int64), np.zeros((1 << depth) - 1)
    members = [np.arange(len(y))]
    for node in range(len(part)):
        rows = y[members[node]]
        part[node] = np.ptp(rows, axis=0).argmax() if len(rows) else 0
        cut[node] = np.median(rows[:, part[node]]) if len(rows) else 0.0
        low = y[members[node], part[node]] < cut[node]
        members += [members[node][low], members[node][~low]]
    return part, cut


def leaves(y: np.ndarray, part: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """The leaf of every row, counted from the left."""
    node, rows = np.zeros(len(y), np.int64), np.arange(len(y))
    for _ in range(len(part).bit_length()):
        node = 2 * node + 1 + (y[rows, part[node]] >= cut[node])
    return node - len(part)


def _groups(points: DataFrame, trees: dict[int, tuple[np.ndarray, np.ndarray]], size: int, near: float) -> DataFrame:
    """Groups in k-d order: width, group, box (lo, hi), slabs of the first component, ids, times and vectors."""
    kind, vector = points.schema["id"].dataType.simpleString(), points.schema["x"].dataType.simpleString()

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths = batch.column("width").to_numpy()
            leaf, lead = np.zeros(len(widths), np.int64), np.zeros(len(widths))
            for width in np.unique(widths).tolist():
                own = np.flatnonzero(widths == width)
                y = _turned(_rows(batch.column("x").take(pa.array(own)), width))
                lead[own] = y[:, 0]
                if width in trees:
                    leaf[own] = leaves(y, *trees[width])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf), pa.array(lead)], [*batch.schema.names, "leaf", "lead"])

    placed = points.select("width", "id", "times", "x").mapInArrow(
        place, f"width int, id {kind}, times bigint, x {vector}, leaf bigint, lead double"
    )
    keys = ["width", "leaf", "lead", "id"]
    # Each task cuts groups of its own, so there are as many tasks as full groups.
    total = points.agg(F.sum("width")).first()[0] or 0
    ordered = placed.repartitionByRange(*keys).sortWithinPartitions(*keys).coalesce(max(1, -(-total // size)))

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def close() -> pa.RecordBatch:
            whole = pa.Table.from_batches(held).combine_chunks()
            width, ids = whole["width"][0].as_py(), whole["id"].combine_chunks()
            x = _rows(whole["x"].combine_chunks(), width)
            y = _turned(x)
            lo, hi = y.min(0), y.max(0)
            ends = pa.array([0, len(ids)], pa.int32())
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([width], pa.int32()),
                    pa.array([lo.tolist()], pa.list_(pa.float64())),
                    pa.array([hi.tolist()], pa.list_(pa.float64())),
                    pa.array([int(np.floor((lo[0] - near) / near))]),
                    pa.array([int(np.floor((hi[0] + near) / near))]),
                    pa.ListArray.from_arrays(ends, ids),
                    pa.ListArray.from_arrays(ends, whole["times"].combine_chunks()),
                    pa.array([_narrow(x)], pa.binary()),
                ],
                ["width", "lo", "hi", "first", "last", "ids", "times", "x"],
            )

        count, width = 0, None
        for batch in batches:
            widths, start = batch.column("width").to_numpy(), 0
            while start < len(widths):
                if held and (widths[start] != width or count >= max(1, size // width)):
                    yield close()
                    held, count = [], 0
                width = int(widths[start])
                end = min(int(np.searchsorted(widths, width, side="right")), start + max(1, size // width) - count)
                held.append(batch.slice(start, end - start))
                count, start = count + end - start, end
        if held:
            yield close()

    schema = (
        "width int, lo array<double>, hi array<double>, first bigint, last bigint, "
        f"ids array<{kind}>, times array<bigint>, x binary"
    )
    return ordered.mapInArrow(cut, schema).withColumn("group", F.monotonically_increasing_id())


def _near_pairs(groups: DataFrame, most: float) -> DataFrame:
    """(width, a, b) of groups, a <= b, whose boxes are within squared distance ``most``."""
    spans = groups.select("width", "group", "lo", "hi", "first", "last")
    slabs = spans.select("*", F.explode(F.sequence("first", "last")).alias("slab"))
    left = slabs.select("width", "slab", *[F.col(c).alias(f"a_{c}") for c in ("group", "lo", "hi", "first")])
    right = slabs.select("width", "slab", *[F.col(c).alias(f"b_{c}") for c in ("group", "lo", "hi", "first")])
    gaps = F.zip_with(
        F.zip_with("a_lo", "b_hi", lambda a, b: a - b),
        F.zip_with("b_lo", "a_hi", lambda b, a: b - a),
        lambda p, q: F.greatest(p, q, F.lit(0.0)),
    )
    apart = F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g * g)
    # Groups may share several slabs; the first of them stands for the pair.
    once = F.col("slab") == F.greatest("a_first", "b_first")
    joined = left.join(right, ["width", "slab"]).filter((F.col("a_group") <= F.col("b_group")) & once)
    return joined.filter(apart <= most + SLACK).select("width", F.col("a_group").alias("a"), F.col("b_group").alias("b"))


def blocks(y: np.ndarray, rows: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """(order, starts): rows in k-d order, and where its blocks of at most ``rows`` rows start."""
    order, done, open_ = np.arange(len(y)), [], [(0, len(y))]
    while open_:
        start, end = open_.pop()
        if end - start <= rows:
            done.append(start)
            continue
        own = order[start:end]
        lead = y[own, np.ptp(y[own], axis=0).argmax()]
        middle = (end - start) // 2
        order[start:end] = own[np.argpartition(lead, middle)]
        open_ += [(start + middle, end), (start, start + middle)]
    return order, np.array(sorted(done))


def range_join(p: np.ndarray, q: np.ndarray | None, budget: float) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Pairs of rows within squared distance ``budget``: (rows of p, rows of q, pairs of blocks compared).

    Without ``q``, pairs of different rows of p, each once. Distances are compared in
    floats, so some pairs a little further apart are among them. Rows are parts of unit
    vectors; longer ones would need a wider margin.
    """
    sides = [(rows, *blocks(rows)) for rows in ((p,) if q is None else (p, q))]
    boxes = []
    for rows, order, starts in sides:
        laid = rows[order]
        square, one = (laid * laid).sum(1), np.ones(len(laid))
        # One product of these gives squared distances.
        left, right = (np.column_stack(c).astype(np.float32) for c in ((-2 * laid, square, one), (laid, one, square)))
        boxes.append((left, right, np.minimum.reduceat(laid, starts), np.maximum.reduceat(laid, starts)))
    order_p, starts_p = sides[0][1:]
    order_q, starts_q = sides[-1][1:]
    (own, _, lo_p, hi_p), (_, other, lo_q, hi_q) = boxes[0], boxes[-1]
    sizes = np.diff(np.append(starts_q, len(other)))
    for k, (start, end) in enumerate(zip(starts_p, np.append(starts_p[1:], len(own)), strict=True)):
        gap = np.maximum(np.maximum(lo_q - hi_p[k], lo_p[k] - hi_q), 0)
        close = (gap * gap).sum(1) <= budget + SLACK
        if q is None:
            close[:k] = False
        spots = np.flatnonzero(np.repeat(close, sizes))
        seen = int(close.sum())
        for first in range(0, len(spots), TILE):
            some = spots[first : first + TILE]
            away = own[start:end] @ other[some].T
            i, j = np.divmod(np.flatnonzero(away <= np.float32(budget + LOOSE)), len(some))
            i, j = i + start, some[j]
            if q is None:
                i, j = i[i < j], j[i < j]
            yield order_p[i], order_q[j], seen
            seen = 0


def _square(y: np.ndarray, z: np.ndarray) -> np.ndarray:
    gap = y - z
    return np.einsum("ij,ij->i", gap, gap)


def links_of(x: np.ndarray, z: np.ndarray | None, threshold: float, subspace: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows with cosine >= ``threshold``, each once; without ``z``, of different rows of x."""
    units = [_units(rows) for rows in ((x,) if z is None else (x, z))]
    ys = [unit @ rotation(x.shape[1]) for unit in units]
    width, most = x.shape[1], 2 * (1 - threshold)
    cuts = [slice(start, min(start + subspace, width)) for start in range(0, width, subspace)]
    budgets = [most * (cut.stop - cut.start) / width for cut in cuts]
    for part, (cut, budget) in enumerate(zip(cuts, budgets, strict=True)):
        # A few more components, beginning with this subspace's, settle nearly all candidates.
        soon = np.arange(cut.start, cut.start + min(SOON, width)) % width
        quick = [y[:, soon].astype(np.float32) for y in ys]
        for i, j, _ in range_join(ys[0][:, cut], None if z is None else ys[1][:, cut], budget):
            for tile in range(0, len(i), TILE):
                a, b = i[tile : tile + TILE], j[tile : tile + TILE]
                left = _square(quick[0][a], quick[-1][b]) <= most + LOOSE
                a, b = a[left], b[left]
                good = (units[0][a] * units[-1][b]).sum(1) >= threshold
                a, b = a[good], b[good]
                # Here only if no subspace before this one has the pair.
                for other in range(part):
                    fresh = _square(ys[0][a, cuts[other]], ys[-1][b, cuts[other]]) > budgets[other] + SLACK / 2
                    a, b = a[fresh], b[fresh]
                mine = _square(ys[0][a, cut], ys[-1][b, cut]) <= budget + SLACK / 2
                if mine.any():
                    yield a[mine], b[mine]


def _forest(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fewer pairs that connect the same numbers: each with the least of its component."""
    nodes, flat = np.unique(np.concatenate([left, right]), return_inverse=True)
    a, b = flat[: len(left)], flat[len(left) :]
    root = np.arange(len(nodes))
    while True:
        before = root.copy()
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        root = root[root]
        if (root == before).all():
            break
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def _verify(pairs: DataFrame, threshold: float, subspace: int) -> DataFrame:
    """(kind, id, other, n) rows: kind 0 counts n links of id, kind 1 connects id and other."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                get = {name: batch.column(name)[at] for name in batch.schema.names}
                sides = "a" if get["a"].as_py() == get["b"].as_py() else "ab"
                ids = [get[f"{s}_ids"].values for s in sides]
                times = [get[f"{s}_times"].values.to_numpy() for s in sides]
                xs = [_wide(get[f"{s}_x"], len(i), get["width"].as_py()) for s, i in zip(sides, ids, strict=True)]
                links = [np.zeros(len(i), np.int64) for i in ids]
                joined: list[tuple[np.ndarray, np.ndarray]] = []
                for i, j in links_of(xs[0], xs[1] if len(xs) > 1 else None, threshold, subspace):
                    links[0] += np.bincount(i, times[-1][j], len(links[0])).astype(np.int64)
                    links[-1] += np.bincount(j, times[0][i], len(links[-1])).astype(np.int64)
                    joined.append(_forest(i, j if len(xs) == 1 else j + len(ids[0])))
                    if len(joined) > 64:
                        joined = [_forest(*(np.concatenate(c) for c in zip(*joined, strict=True)))]
                both = pa.concat_arrays(ids)
                for names, counts in zip(ids, links, strict=True):
                    some = np.flatnonzero(counts)
                    if len(some):
                        name = names.take(pa.array(some))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.zeros(len(some), np.int32)), name, name, pa.array(counts[some])],
                            ["kind", "id", "other", "n"],
                        )
                if joined:
                    a, b = _forest(*(np.concatenate(c) for c in zip(*joined, strict=True)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.ones(len(a), np.int32)), both.take(pa.array(a)), both.take(pa.array(b)), pa.array(np.ones(len(a), np.int64))],
                        ["kind", "id", "other", "n"],
                    )

    kind = pairs.schema["a_ids"].dataType.elementType.simpleString()
    return pairs.mapInArrow(run, f"kind int, id {kind}, other {kind}, n bigint")


def _trees(points: DataFrame, sample: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """The k-d tree of each vector length among at most ``sample`` points; only the order of rows depends on it."""
    chosen = points.orderBy(F.xxhash64("x"), "id").limit(sample).select("width", "x").toArrow()
    widths, x = chosen["width"].to_numpy(), chosen["x"].combine_chunks()
    return {
        width: fit_tree(_turned(_rows(x.take(pa.array(np.flatnonzero(widths == width))), width)))
        for width in np.unique(widths).tolist()
    }


def near_duplicates(
    embeddings: DataFrame, threshold: float = THRESHOLD, subspace: int = SUBSPACE, group: int = GROUP, sample: int = SAMPLE
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    ``n_links`` counts the other rows at cosine >= ``threshold``, in doubles;
    ``component_id`` is the smallest vec_id that links reach. Rows whose vector is
    null, empty, all zero or holds null or non-finite components have no links and are
    their own component. Vectors link only with others of their length, whichever
    lengths there are. Rows that repeat, or share an id, count as rows of their own in
    ``n_links``. A row without an id takes part; its component is that of the ids it
    reaches, or null. An empty table gives an empty one. Columns other than vec_id and
    embedding are not read.
    """
    rows = stored(usable(embeddings), "vectors")
    points = rows.filter("x is not null").groupBy("x").agg(F.count(F.lit(1)).alias("times"), F.min("vec_id").alias("first_id"))
    points = points.withColumn("width", F.size("x")).withColumn("id", F.monotonically_increasing_id())
    points = stored(points, "points")
    most = 2 * (1 - threshold)
    groups = stored(_groups(points, _trees(points, sample), group, float(np.sqrt(most))), "vector-groups")
    pairs = stored(_near_pairs(groups, most), "group-pairs")
    named = {s: groups.select(F.col("group").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in ("ids", "times", "x")]) for s in "ab"}
    full = pairs.join(named["a"], "a").join(named["b"], "b")
    found = stored(_verify(full, threshold, subspace), "links")
    links = found.filter("kind = 0").groupBy("id").agg(F.sum("n").alias("n"))
    roots = components(found.filter("kind = 1"), "id", "other")
    whole = points.join(links, "id", "left").join(roots, points["id"] == roots["node"], "left")
    whole = whole.select(
        "x", "first_id", "times", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("component", "id").alias("root")
    )
    firsts = whole.groupBy("root").agg(F.min("first_id").alias("component_id"))
    whole = whole.join(firsts, "root").select("x", (F.col("n") + F.col("times") - 1).alias("n"), "component_id")
    joined = rows.join(whole, "x", "left")
    component = F.when(F.col("n").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return joined.select(
        "vec_id", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )


# All pairs, as SQL has no subspaces to join by; components by a recursive walk.
ORACLE = f"""
WITH RECURSIVE good AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
    AND len(list_filter(embedding, lambda v: v <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
  ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.x, b.x) >= {THRESHOLD}
), walk AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT w.a, l.b FROM walk w JOIN links l ON w.b = l.a
), roots AS (SELECT a AS vec_id, min(b) AS component_id FROM walk GROUP BY a
), counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a
)
SELECT r.vec_id, CAST(coalesce(c.n, 0) AS BIGINT) AS n_links, r.component_id, r.vec_id = r.component_id AS kept
FROM roots r LEFT JOIN counts c ON r.vec_id = c.vec_id
"""
