"""Vector searches and joins against brute force."""

from __future__ import annotations

import math

import numpy as np
import pytest

from tidemark.llm import subspaces, topk
from tidemark.llm.components import components

SCHEMA = "vec_id bigint, embedding array<float>, label int, v string, x int, rank int, part int"
EXTRA = (0, "v", 1, 2, 3)


def odd_vectors(spark, rng):
    rows = [(i, rng.normal(size=6).astype(np.float32).tolist(), *EXTRA) for i in range(60)]
    rows += [(100 + i, rows[i][1], *EXTRA) for i in range(5)]
    rows += [
        (200, None, *EXTRA),
        (220, [0.0] * 6, *EXTRA),
        (240, [1.0, None, 0.0, 0.0, 0.0, 0.0], *EXTRA),
        (260, [float("nan"), *[0.0] * 5], *EXTRA),
        (280, [float("inf"), *[0.0] * 5], *EXTRA),
        (None, rows[3][1], *EXTRA),
        rows[7],
    ]
    return rows, spark.createDataFrame(rows, SCHEMA)


def whole_vector(vector):
    if vector is None or any(x is None or not math.isfinite(x) for x in vector):
        return None
    return [math.floor(64 * float(x)) for x in vector]


def test_top_k_against_all_scores(spark):
    rows, table = odd_vectors(spark, np.random.default_rng(1))
    for k, options in ((20, {}), (3, {"pivots": 4, "annulus": 5, "chunk": 2}), (100, {"pivots": 3, "annulus": 7})):
        got = {}
        for r in topk.every(table, k=k, **options).collect():
            got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
        usable = {i: whole_vector(v) for i, v, *_ in rows if i is not None and whole_vector(v)}
        for query, left in usable.items():
            if query % 20:
                continue
            scores = sorted((-sum(a * b for a, b in zip(left, right, strict=True)), i) for i, right in usable.items() if i != query)
            assert sorted(got[query]) == [(n, i, -s) for n, (s, i) in enumerate(scores[:k], 1)]
        assert set(got) == {i for i in usable if i % 20 == 0}


def test_top_k_of_large_numbers_is_exact(spark):
    rows = [(i, [float(i * 1e6), 3.5]) for i in range(0, 60, 20)] + [(1, [1e6, 0.5]), (2, [1e6, 0.25])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = {(r.query_id, r.vec_id): r.score for r in topk.every(table).collect()}
    assert found[20, 1] == int(64 * 20e6) * int(64e6) + 224 * 32
    assert found[20, 2] == int(64 * 20e6) * int(64e6) + 224 * 16


def test_top_k_refuses_numbers_beyond_64_bits(spark):
    fine = [(0, [1e15, 1.0]), (1, [1.0, 1e10])]
    table = spark.createDataFrame(fine, "vec_id bigint, embedding array<double>")
    assert topk.every(table).first().score == 64 * 10**15 * 64 + 64 * 64 * 10**10
    for row in ((2, [4.0, 2.0]), (2, [1e30, 0.0])):
        table = spark.createDataFrame([*fine, row], "vec_id bigint, embedding array<double>")
        with pytest.raises(Exception, match="64 bits"):
            topk.every(table).collect()


def test_top_k_with_many_ties(spark):
    """Copies in many blocks: the smallest ids win, and later blocks return none that lose."""
    rows = [(i, [1.0, float(i % 3)]) for i in range(400)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    whole = {i: [64, 64 * (i % 3)] for i, _ in rows}
    got = {}
    for r in topk.every(table, k=5, pivots=3, annulus=9, chunk=4).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    for query in range(0, 400, 20):
        scores = sorted((-sum(a * b for a, b in zip(whole[query], v, strict=True)), i) for i, v in whole.items() if i != query)
        assert sorted(got[query]) == [(n, i, -s) for n, (s, i) in enumerate(scores[:5], 1)]


def test_expansion_stops_where_bounds_allow():
    """Clustered vectors: far annuli are not compared, and nothing is lost."""
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(40, 16)) * 200
    rows = np.floor(centres[np.repeat(np.arange(40), 50)] + rng.normal(size=(2000, 16)) * 3).astype(np.int64)
    rows = np.floor(rows / np.sqrt((rows * rows).sum(1, keepdims=True)) * 800).astype(np.int64)
    longest = float((rows * rows).sum(1).max())
    pivots = np.hstack([rows[::50].astype(float), np.sqrt(longest - (rows[::50] ** 2).sum(1))[:, None]])
    away = topk._distances(rows.astype(float), pivots, longest, True)
    home = away.argmin(1)
    queries = np.arange(0, 50, 5)
    none = np.zeros(len(queries), np.int64)
    search = topk.Expansion(queries, rows[queries], none, none, none.astype(bool), 5)
    from_pivot = topk._distances(rows[queries].astype(float), pivots, longest, False)
    blocks = [(p, away[home == p, p].min(), away[home == p, p].max()) for p in np.unique(home)]
    for p, lo, hi in sorted(blocks, key=lambda b: np.maximum(from_pivot[:, b[0]] - b[2], b[1] - from_pivot[:, b[0]]).min()):
        near = np.maximum(from_pivot[:, p] - hi, lo - from_pivot[:, p])
        ids = np.flatnonzero(home == p)
        search.visit(ids, rows[ids], np.flatnonzero(near <= search.radii(longest)))
    assert search.compared < len(blocks) / 2
    for at, query in enumerate(queries.tolist()):
        scores = sorted((-int(rows[query] @ rows[i]), i) for i in range(len(rows)) if i != query)[:5]
        assert list(zip((-search.best[at][0]).tolist(), search.best[at][1].tolist(), strict=True)) == scores


def test_top_k_of_nothing(spark):
    table = spark.createDataFrame([], SCHEMA)
    assert topk.every(table).count() == 0
    alone = spark.createDataFrame([(20, [1.0, 2.0])], "vec_id bigint, embedding array<float>")
    assert topk.every(alone).count() == 0


def plain_links(vectors, threshold):
    good = [v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v) for v in vectors]
    n, root = [0] * len(vectors), list(range(len(vectors)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i in range(len(vectors)):
        for j in range(i):
            if good[i] and good[j]:
                a, b = np.array(vectors[i], float), np.array(vectors[j], float)
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold:
                    n[i], n[j] = n[i] + 1, n[j] + 1
                    root[find(i)] = find(j)
    return n, [find(i) for i in range(len(vectors))]


@pytest.mark.parametrize("options", [{}, {"subspace": 2, "group": 64}, {"subspace": 5, "group": 24, "sample": 40}])
def test_embedding_links_against_all_pairs(spark, options):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 8))
    vectors = [(centres[rng.integers(6)] + rng.normal(size=8) * 0.12).astype(np.float32).tolist() for _ in range(120)]
    vectors += vectors[:4] + [[3 * x for x in vectors[5]], None, [0.0] * 8, [None] * 8, [float("nan")] * 8]
    rows = [(i, v) for i, v in enumerate(vectors)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    n, root = plain_links(vectors, 0.95)
    least = {}
    for i, r in enumerate(root):
        least[r] = min(least.get(r, i), i)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in subspaces.near_duplicates(table, **options).collect()}
    assert got == {i: (n[i], least[root[i]], i == least[root[i]]) for i in range(len(vectors))}
    assert max(n) > 10


def test_links_of_every_vector_length(spark):
    rng = np.random.default_rng(5)
    vectors = [rng.normal(size=3).tolist() for _ in range(5)]
    vectors += [[1.0, 2.0], [1.0, 2.0], [2.0, 4.0], [2.0, -1.0], [5.0], [7.0], [-1.0], []]
    table = spark.createDataFrame(list(enumerate(vectors)), "vec_id bigint, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in subspaces.near_duplicates(table, threshold=0.999).collect()}
    assert [got[i] for i in (5, 6, 7, 8)] == [(2, 5), (2, 5), (2, 5), (0, 8)]
    assert [got[i] for i in (9, 10, 11, 12)] == [(1, 9), (1, 9), (0, 11), (0, 12)]
    assert all(got[i] == (0, i) for i in range(5))


def test_planted_neighbours_among_many_wide_vectors(spark):
    """20,000 vectors of width 64 in several groups, against all cosines."""
    rng = np.random.default_rng(6)
    base = rng.normal(size=(18_000, 64))
    near = base[rng.integers(0, 18_000, 1500)] + rng.normal(size=(1500, 64)) * rng.choice([0.1, 0.3, 0.4], (1500, 1))
    dense = base[0] + rng.normal(size=(500, 64)) * 0.2
    x = np.concatenate([base, near, dense])[rng.permutation(20_000)].astype(np.float32).astype(np.float64)
    units = x / np.sqrt((x * x).sum(1, keepdims=True))
    n, links = np.zeros(len(x), int), []
    for top in range(0, len(x), 2000):
        i, j = np.nonzero(units[top : top + 2000] @ units.T >= 0.95)
        i += top
        n += np.bincount(i[i != j], minlength=len(x))
        links += [(a, b) for a, b in zip(i.tolist(), j.tolist(), strict=True) if a < b]
    root = list(range(len(x)))

    def find(a):
        while root[a] != a:
            root[a] = root[root[a]]
            a = root[a]
        return a

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    table = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id bigint, embedding array<float>")
    rows = subspaces.near_duplicates(table, group=1 << 18).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in rows} == {i: (n[i], find(i)) for i in range(len(x))}
    assert n.sum() > 200_000


def test_blocks_that_are_left_out_hold_no_pair():
    rng = np.random.default_rng(7)
    y = np.concatenate([rng.normal(size=(3000, 4)) * 0.125, np.repeat(rng.normal(size=(1, 4)) * 0.125, 200, 0)])
    z = rng.normal(size=(4000, 4)) * 0.125
    budget = 0.1 / 16
    for other in (None, z):
        pairs, seen = [], 0
        for i, j, compared in subspaces.range_join(y, other, budget):
            seen += compared
            pairs += [(min(a, b), max(a, b)) if other is None else (a, b) for a, b in zip(i.tolist(), j.tolist(), strict=True)]
        away = ((y[:, None] - (y if other is None else other)[None]) ** 2).sum(2)
        want = {(a, b) for a, b in zip(*map(np.ndarray.tolist, np.nonzero(away <= budget)), strict=True) if other is not None or a < b}
        assert len(pairs) == len(set(pairs)) and want <= set(pairs)
        left, right = (len(subspaces.blocks(rows)[1]) for rows in (y, y if other is None else other))
        assert 0 < seen < 0.5 * left * right


def test_a_tree_deals_rows_into_even_leaves():
    y = np.random.default_rng(8).normal(size=(4096, 6))
    part, cut = subspaces.fit_tree(y)
    sizes = np.bincount(subspaces.leaves(y, part, cut))
    assert len(sizes) == 128 and sizes.min() == sizes.max() == 32
    assert subspaces.leaves(y[:3], *subspaces.fit_tree(y[:3])).tolist() == [0, 0, 0]


def test_embedding_links_of_odd_rows(spark):
    rows, table = odd_vectors(spark, np.random.default_rng(3))
    found = subspaces.near_duplicates(table)
    assert found.count() == len(rows)
    by_id = {r.vec_id: r for r in found.collect()}
    assert by_id[100].component_id == 0 and by_id[100].n_links == 1 and not by_id[100].kept
    assert by_id[3].n_links == 2 and by_id[200].kept and by_id[280].n_links == 0
    assert by_id[None].component_id == 3 and by_id[7].n_links == 1
    assert subspaces.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(300, 300), (207, 205), (205, 207)]
    found = components(spark.createDataFrame(links, "p bigint, q bigint"), "p", "q")
    got = {r.node: r.component for r in found.collect()}
    want = {i: 0 for i in range(41)} | {100 + k: 100 for k in range(30)} | {205: 205, 207: 205}
    assert got == want


def test_a_comparison_of_blocks_takes_few_bytes_a_pair():
    import tracemalloc

    draw = np.random.default_rng(4)
    # The box of p holds all of q, but no row of p is near one.
    p, q = draw.choice([-1.0, 1.0], (subspaces.BLOCK, 4)), draw.uniform(-0.5, 0.5, (1 << 15, 4))
    tracemalloc.start()
    try:
        found = [len(i) for i, _, _ in subspaces.range_join(p, q, 0.01)]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert found and not sum(found) and peak < 10 * len(p) * len(q)
