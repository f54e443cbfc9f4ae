"""Exact search of many queries through pivot cells against brute force: odd vectors, ties, few rows, how little is visited."""

import numpy as np
import pytest

from agentlake.operators import neighbours as nn


def brute(corpus, queries, k, metric):
    out = {}
    for q, qv in queries:
        scored = []
        for i, v in corpus:
            s = nn._scores(nn._stack([v], 4), nn._stack([qv], 4), metric)[0, 0]
            scored.append((np.isnan(s), -s if not np.isnan(s) else 0.0, i))
        out[q] = [(i, None if bad else round(s if metric == "l2" else -s, 9) + 0.0) for bad, s, i in sorted(scored)[:k]]
    return out


def run(spark, corpus, queries, k, metric, monkeypatch, cell=8):
    monkeypatch.setattr(nn, "ROWS_A_CELL", cell)
    monkeypatch.setattr(nn, "CORPUS_BLOCK", 5)
    monkeypatch.setattr(nn, "QUERIES_A_TILE", 7)
    c = spark.createDataFrame(corpus, "id long, vec array<double>")
    q = spark.createDataFrame(queries, "query_id long, vec array<double>")
    found = {}
    for r in nn.nearest(c, q, k, metric, max_carried=0).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.id, None if r[3] is None else round(r[3], 9) + 0.0))
    return found


@pytest.mark.parametrize("metric", ["cosine", "l2"])
@pytest.mark.parametrize("k", [1, 4])
def test_brute_force(spark, metric, k, monkeypatch):
    rng = np.random.default_rng(k)
    centre = rng.standard_normal((6, 4)) * 3
    row = lambda: [float(x) for x in centre[rng.integers(6)] + rng.standard_normal(4) * 0.2]
    corpus = [(i, row()) for i in range(90)]
    corpus[3] = (3, corpus[50][1])  # a tie
    corpus[4] = (4, [2 * x for x in corpus[50][1]])
    corpus += [(100, None), (101, [0.0] * 4), (102, [float("nan"), 0.0, 0.0, 0.0]), (103, None)]
    queries = [(i, row()) for i in range(30)] + [(40, None), (41, [0.0] * 4), (42, corpus[50][1])]
    assert run(spark, corpus, queries, k, metric, monkeypatch) == brute(corpus, queries, k, metric)


def test_few_rows(spark, monkeypatch):
    corpus = [(1, [1.0, 0.0, 0.0, 0.0]), (2, None), (3, [0.0, 1.0, 0.0, 0.0]), (4, [0.0] * 4)]
    queries = [(i, [1.0, float(i), 0.0, 0.0]) for i in range(5)] + [(9, None)]
    for k in (2, 3, 10):
        assert run(spark, corpus, queries, k, "cosine", monkeypatch, cell=1) == brute(corpus, queries, k, "cosine")
    assert run(spark, [(2, None)], queries, 2, "l2", monkeypatch) == brute([(2, None)], queries, 2, "l2")
    assert run(spark, [], queries, 2, "l2", monkeypatch) == {}


def test_cells_are_ruled_out(spark):
    rng = np.random.default_rng(2)
    centre = rng.standard_normal((40, 16)) * 5
    pivots = nn._Pivots(list(centre), "l2")
    pivots.rows[:], pivots.radius[:] = 10, 1.0
    x = centre[rng.integers(0, 40, 300)] + rng.standard_normal((300, 16)) * 0.1
    home = pivots.distances(x).argmin(axis=1)
    seen = pivots.visited(list(x), np.full(300, -1.0), home)
    assert sum(map(len, seen)) < 300 * 2  # of 39 others
    away = np.sqrt(((x[:, None, :] - centre[None]) ** 2).sum(2))
    must = (away - 1.0 <= 1.0) & (np.arange(40)[None, :] != home[:, None])
    assert all(set(np.flatnonzero(m)) <= set(s) for m, s in zip(must, seen))


@pytest.mark.parametrize("metric", ["cosine", "l2"])
def test_screened_tiles_score_as_all_rows(metric):
    rng = np.random.default_rng(0)
    c = rng.standard_normal((3000, 8))
    c[100:700], c[800], c[801], c[802:900] = c[5], np.nan, 0, c[7] * 2  # copies, no score, scaled copies
    c[1000:1500] = c[9] + rng.standard_normal((500, 8)) * 1e-6  # closer than single precision tells apart
    q, ids = np.vstack([c[:1200:3], c[800:802]]), rng.permutation(3000)
    for got, want in zip(nn._best(c, ids, q, 3, metric), nn._best_of_all(c, ids, q, 3, metric)):
        assert np.array_equal(got, want, equal_nan=got.dtype.kind == "f")
    if metric == "cosine":
        got = nn._best(c * 1e200, ids, q * 1e200, 3, metric)  # lengths that are not finite
        assert all(np.array_equal(a, b, equal_nan=a.dtype.kind == "f") for a, b in zip(got, nn._best_of_all(c * 1e200, ids, q * 1e200, 3, metric)))



def test_few_products_are_scored_in_double(monkeypatch):
    rng = np.random.default_rng(1)
    c = rng.standard_normal((8000, 16))
    seen = []
    scored = nn._scores
    monkeypatch.setattr(nn, "_scores", lambda a, b, m: seen.append(len(a) * len(b)) or scored(a, b, m))
    nn._best(c, np.arange(8000), c[:500], 3, "cosine")
    assert sum(seen) < 8000 * 500 / 10


def test_many_queries_move_few_rows():
    """A query goes to a few large cells, not to hundreds of small ones."""
    assert nn.ROWS_A_CELL >= 8192 and nn.QUERY_BLOCK >= 8192
