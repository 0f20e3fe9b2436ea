from __future__ import annotations

import numpy as np
import pytest

from tickloom.llm import graph_ann, maxscore, vectors
from tickloom.session import Scratch

SCHEMA = "vec_id long, embedding array<float>, label int, v string, shard string"


def table(spark, n=900, d=12, hot=200, seed=1):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, d)).astype(np.float32)
    x[:hot] = x[0]
    rows = [(i, x[i].tolist(), 0, "v", "s") for i in range(n)]
    odd = [
        (5000, None, 0, "v", "s"),
        (5100, [float("nan")] * d, 0, "v", "s"),
        (5200, [float("inf")] + [1.0] * (d - 1), 0, "v", "s"),
        (5300, [None] + [1.0] * (d - 1), 0, "v", "s"),
        (5400, [], 0, "v", "s"),
        (None, x[3].tolist(), 0, "v", "s"),
        (5500, x[7].tolist()[:5], 0, "v", "s"),
        (5600, [0.0] * d, 0, "v", "s"),
    ]
    return spark.createDataFrame(rows + odd + rows[:3], SCHEMA), x


def test_exact_top_k(spark, monkeypatch):
    monkeypatch.setattr(vectors, "SHARD_ROWS", 150)
    monkeypatch.setattr(vectors, "BLOCK_ROWS", 5)
    monkeypatch.setattr(vectors, "PACKED_ROWS", 2)
    df, x = table(spark)
    found = maxscore.top_k(Scratch(spark), df).collect()
    whole = np.floor(1024 * x.astype(np.float64))
    vectors_of = {i: whole[i] for i in range(len(x))} | {5600: np.zeros(x.shape[1])}
    for q in [*range(0, 900, 100), 5600]:
        best = sorted((-int(vectors_of[q] @ v), i) for i, v in vectors_of.items() if i != q)[:10]
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in found if r["query_id"] == q)
        assert mine == [(k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert {r["query_id"] for r in found} == {*range(0, 900, 100), 5600}


@pytest.mark.parametrize("kind", ["dense", "sparse", "ties", "positive"])
def test_postings_find_all_competitive_vectors(kind):
    r = np.random.default_rng(3)
    m = r.integers(-1000, 1000, (400, 16)).astype(float)
    if kind == "sparse":
        m[r.random(m.shape) < 0.8] = 0
    if kind == "ties":
        m = np.sign(m)
    if kind == "positive":
        m = np.abs(m) ** 3 // 1e6
    postings = maxscore.Postings(m)
    for q in m[:40]:
        at, scores = postings.top(q, 11)
        true = m @ q
        least = np.sort(true)[-11]
        assert set(np.flatnonzero(true >= least)) <= set(at.tolist())
        assert np.array_equal(scores, true[at])


def test_nearest_neighbours(spark, monkeypatch):
    monkeypatch.setattr(graph_ann, "SHARD_ROWS", 300)
    monkeypatch.setattr(vectors, "BLOCK_ROWS", 5)
    monkeypatch.setattr(vectors, "PACKED_ROWS", 3)
    df, x = table(spark)
    found = graph_ann.nearest(Scratch(spark), df).collect()
    assert {r["query_id"] for r in found} == set(range(0, 900, 100))
    hits = 0
    for q in range(0, 900, 100):
        distance = np.sqrt(((x.astype(np.float64) - x[q].astype(np.float64)) ** 2).sum(1))
        best = sorted((distance[i], i) for i in range(len(x)) if i != q)[:10]
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in found if r["query_id"] == q)
        assert [k for k, _, _ in mine] == list(range(1, 11))
        assert [(s, i) for _, i, s in mine] == sorted((s, i) for _, i, s in mine)
        assert all(s == pytest.approx(distance[i], rel=1e-12, abs=1e-12) for _, i, s in mine)
        hits += len({i for _, i, _ in mine} & {i for _, i in best})
    assert hits >= 0.9 * 90


def test_few_and_no_vectors(spark):
    one = spark.createDataFrame([(100, [1.0, 2.0], 0, "v", "s"), (1, [2.0, 1.0], 0, "v", "s")], SCHEMA)
    for search in (maxscore.top_k, graph_ann.nearest):
        assert [(r["query_id"], r["vec_id"]) for r in search(Scratch(spark), one).collect()] == [(100, 1)]
        assert search(Scratch(spark), one.limit(0)).collect() == []
        assert search(Scratch(spark), one.limit(1)).collect() == []


def test_pruned_edges_are_diverse():
    points = np.array([[0, 0], [1, 0], [1.1, 0], [0, 1], [5, 5]], np.float32)
    squares = (points**2).sum(1)
    kept = graph_ann.robust_prune(points, squares, np.array([0]), np.array([[1, 2, 3, 4, 1, 0, -1]]), 1.0)[0]
    assert [k for k in kept if k >= 0] == [1, 3]


@pytest.mark.parametrize("size", [10**6, 10**9, 10**15])
def test_scores_of_large_components_are_whole_numbers(spark, size):
    r = np.random.default_rng(7)
    x = r.uniform(-size, size, (260, 64))
    # Close rivals: scores that differ in their last digits.
    x[200:] = x[0] + r.integers(-3, 4, (60, 64)) / 1024
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = maxscore.top_k(Scratch(spark), df).collect()
    whole = [[int(np.floor(1024 * c)) for c in v] for v in x]
    for q in (0, 100, 200):
        best = sorted((-sum(a * b for a, b in zip(whole[q], v, strict=True)), i) for i, v in enumerate(whole) if i != q)[:10]
        mine = sorted((f["rank"], f["vec_id"], f["score"]) for f in found if f["query_id"] == q)
        if all(-s < maxscore.LARGEST for s, _ in best):
            assert mine == [(k + 1, i, -s) for k, (s, i) in enumerate(best)]
        else:
            assert all(f[2] <= maxscore.LARGEST for f in mine) and len(mine) == 10


def test_scores_beyond_64_bits_rank_by_what_they_are():
    r = np.random.default_rng(8)
    whole = r.integers(-(2**52), 2**52, (300, 16))
    postings = maxscore.Postings(whole)
    for q in whole[:5]:
        at, scores = postings.top(q, 11)
        true = [sum(int(a) * int(b) for a, b in zip(q, v, strict=True)) for v in whole]
        assert set(sorted(range(300), key=lambda i: -true[i])[:11]) <= set(at.tolist())
        assert [int(s) for s in scores] == [true[i] for i in at]


def test_beam_search_looks_at_few_of_the_vectors():
    r = np.random.default_rng(5)
    points = (r.normal(size=(60, 24))[r.integers(0, 60, 9000)] + 0.6 * r.normal(size=(9000, 24))).astype(np.float32)
    points -= points.mean(0)
    squares = (points**2).sum(1)
    graph, entry = graph_ann.build_graph(points)
    queries = points[:200]
    found, _, looked = graph_ann.beam_search(points, squares, graph, entry, queries, graph_ann.SEARCH_BEAM)
    true = np.argsort(squares - 2 * queries @ points.T, 1, kind="stable")[:, :11]
    recall = np.mean([len(set(a.tolist()) & set(b.tolist())) for a, b in zip(found, true, strict=True)]) / 11
    assert recall >= 0.9 and looked < 0.1 * points.shape[0] * len(queries)
    assert all(len(set(row[row >= 0].tolist())) == (row >= 0).sum() for row in found)


@pytest.mark.parametrize("kind", ["unequal lengths", "far clusters"])
def test_nearest_neighbours_of_harder_vectors(spark, monkeypatch, kind):
    monkeypatch.setattr(graph_ann, "SHARD_ROWS", 2000)
    r = np.random.default_rng(11)
    x = r.normal(size=(4000, 48))
    if kind == "unequal lengths":
        x *= np.exp(2 * r.normal(size=(4000, 1)))
    else:
        x = 1e6 * x[r.integers(0, 40, 4000)] + 1e-2 * x
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = graph_ann.nearest(Scratch(spark), df).collect()
    hits = 0
    for q in range(0, 4000, 100):
        distance = np.sqrt(((x - x[q]) ** 2).sum(1))
        distance[q] = np.inf
        mine = {f["vec_id"] for f in found if f["query_id"] == q}
        hits += len(mine & set(np.argsort(distance, kind="stable")[:10].tolist()))
    assert hits >= 0.9 * 400
