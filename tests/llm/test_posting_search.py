"""Nearest neighbours against brute force."""

import numpy as np
import pytest

from tally.llm import posting_search as ps

SCHEMA = "vec_id long, embedding array<float>, score string"


def brute(rows, queries, k=10):
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], dtype=np.float32).astype(float)
    out = {}
    for q in queries:
        d = np.sqrt(((x - x[np.flatnonzero(ids == q)[0]]) ** 2).sum(1))
        d[ids == q] = np.inf
        o = [i for i in np.lexsort((ids, d)) if np.isfinite(d[i])][:k]
        out[q] = [(int(ids[i]), float(d[i])) for i in o]
    return out


def read(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        assert r["rank"] == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def test_recall_on_clusters(spark):
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(20, 16))
    rows = [(i, (centers[i % 20] + rng.normal(size=16) * 0.4).tolist(), None) for i in range(4000)]
    got = read(ps.nearest(spark.createDataFrame(rows, SCHEMA), lambda v: v % 100 == 0))
    want = brute(rows, range(0, 4000, 100))
    assert set(got) == set(want)
    hits = sum(len({a for a, _ in got[q]} & {a for a, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 10 * len(want)
    for q in got:
        exact = {a: d for a, d in brute(rows, [q], 4000)[q]}
        assert all(abs(exact[a] - d) < 1e-12 for a, d in got[q])


def test_ties_bad_vectors_and_few_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(100, [1.0, 0.0], "x"), (7, [1.0, 0.0], None), (3, [1.0, 0.0], None), (5, [0.0, 2.0], None),
            (1, None, None), (2, [], None), (4, [0.0, 0.0], None), (6, [nan, 1.0], None), (8, [inf, 1.0], None),
            (9, [None, 1.0], None), (10, [1.0, 2.0, 3.0], None), (None, [1.0, 1.0], None), (7, [1.0, 0.0], None)]
    got = read(ps.nearest(spark.createDataFrame(rows, SCHEMA), lambda v: v % 100 == 0))
    assert got == {100: [(3, 0.0), (7, 0.0), (5, pytest.approx(5 ** 0.5))]}


def test_many_copies_of_one_vector(spark):
    rows = [(i, [1.0, 1.0, 1.0], None) for i in range(700)] + [(1000 + i, [float(i), 2.0, 0.5], None) for i in range(50)]
    got = read(ps.nearest(spark.createDataFrame(rows, SCHEMA), lambda v: v % 100 == 0))
    assert got[0] == [(i, 0.0) for i in range(1, 11)]
    assert got[300] == [(i, 0.0) for i in range(10)]


def test_parts_of_large_lists(spark, monkeypatch):
    monkeypatch.setattr(ps, "PART_VECTORS", 50)
    monkeypatch.setattr(ps, "PART_QUERIES", 3)
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=4).tolist(), None) for i in range(900)]
    got = read(ps.nearest(spark.createDataFrame(rows, SCHEMA), lambda v: v % 10 == 0))
    want = brute(rows, range(0, 900, 10))
    hits = sum(len({a for a, _ in got[q]} & {a for a, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 10 * len(want)


def test_empty(spark):
    assert ps.nearest(spark.createDataFrame([], SCHEMA), lambda v: v % 100 == 0).count() == 0
    assert ps.nearest(spark.createDataFrame([(100, None, None)], SCHEMA), lambda v: v % 100 == 0).count() == 0
    assert ps.nearest(spark.createDataFrame([(100, [1.0], None)], SCHEMA), lambda v: v % 100 == 0).count() == 0


def test_graph_search_finds_the_nearest_centroids():
    rng = np.random.default_rng(0)
    points = rng.normal(size=(600, 12)).astype(np.float32)
    graph = ps.Centroids(points, rng)
    x = rng.normal(size=(50, 12)).astype(np.float32)
    ids, d = graph.search(x, 8)
    want = np.argsort(ps.distances(x, points), axis=1)[:, :8]
    assert np.mean([len(set(a) & set(b)) / 8 for a, b in zip(ids, want)]) > 0.9
    assert (np.diff(d, axis=1) >= 0).all() and all(len(set(r)) == 8 for r in ids.tolist())


def unit_vectors(n, dim=64, seed=5):
    """No direction is favoured, as in the given embeddings: most lists are about equally far."""
    x = np.random.default_rng(seed).normal(size=(n, dim))
    return [(i, v.tolist(), None) for i, v in enumerate(x / np.linalg.norm(x, axis=1, keepdims=True))]


def test_recall_where_lists_are_many_and_equally_far(spark, monkeypatch):
    monkeypatch.setattr(ps, "LIST_VECTORS", 16)     # 188 lists, far more than a search begins with
    monkeypatch.setattr(ps, "PROBES", 12)
    rows = unit_vectors(3000)
    got = read(ps.nearest(spark.createDataFrame(rows, SCHEMA), lambda v: v % 100 == 0))
    want = brute(rows, range(0, 3000, 100))
    hits = sum(len({a for a, _ in got[q]} & {a for a, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 10 * len(want)


def test_exact_nearest_ranks_as_brute_force(spark):
    rows = [(i, [float(i % 7), float(i % 3)], None) for i in range(300)]
    x = np.array([rows[i][1] for i in (0, 100)], dtype=np.float32)
    got = ps.exact_nearest(spark.createDataFrame(rows, SCHEMA), np.array([0, 100]), x, 10).collect()
    want = brute(rows, [0, 100])
    assert {(r["query"], r.vec_id) for r in got} == {(j, v) for j, q in enumerate((0, 100)) for v, _ in want[q]}


def test_vectors_near_boundaries_are_in_several_lists():
    x = np.array([r[1] for r in unit_vectors(2000)], dtype=np.float32)
    rng = np.random.default_rng(0)
    graph = ps.Centroids(ps.balanced_kmeans(x, 16, rng), rng)
    rows, lists = graph.replicas(x)
    copies = np.bincount(rows, minlength=len(x))
    assert copies.min() >= 1 and copies.max() <= ps.MAX_REPLICAS and copies.mean() > 2
    assert len(set(zip(rows.tolist(), lists.tolist()))) == len(rows)
    centre = graph.replicas(graph.points)       # at a centroid no other list is near
    assert (np.bincount(centre[0]) == 1).all()
