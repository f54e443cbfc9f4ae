"""Clustering against plain Lloyd rounds; the geometric bounds against sampled spheres."""

from hashlib import sha256

import numpy as np
import pytest

from agentlake.llm import centroids as C
from agentlake.llm import entries
from agentlake.plans.check import compare, connect


def test_query(spark, sf):
    name = "op11_centroid_clusters"
    ok, message, _ = compare(spark, connect(sf), sf, name, entries.QUERIES[name], entries.ORACLE[name])
    assert ok, message


def plain(rows, k, rounds, dim):
    """The rounds in whole numbers, one vector after the other."""
    kept = [
        (key, [int(np.floor(256 * float(x))) for x in v]) for key, v in rows
        if v is not None and len(v) == dim and all(x is not None and np.isfinite(x) and abs(x) < 2**18 for x in v)
    ]
    order = sorted(kept, key=lambda r: (r[0] is None, sha256(f"2:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    cent = [v for _, v in order[:k]]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda v: min((dist(v, c), i) for i, c in enumerate(cent))
    for _ in range(rounds):
        at = [nearest(v)[1] for _, v in kept]
        for i in range(len(cent)):
            mine = [v for (_, v), a in zip(kept, at) if a == i]
            if mine:
                cent[i] = [sum(col) // len(mine) for col in zip(*mine)]
    last = [nearest(v) for _, v in kept]
    per = {i: sum(d for d, a in last if a == i) for _, i in last}
    digest = lambda c: sha256(",".join(map(str, c)).encode()).hexdigest()
    return sorted(((key, i, d, per[i], sum(per.values()), digest(cent[i])) for (key, _), (d, i) in zip(kept, last)), key=str)


def result(df, **kw):
    return sorted((tuple(r)[:6] for r in C.cluster(df, **kw).collect()), key=str)


@pytest.mark.parametrize("scale, k, dim", [(1.0, 7, 5), (0.02, 9, 3), (30000.0, 4, 8), (1.0, 1, 2)])
def test_plain_rounds(spark, scale, k, dim):
    rng = np.random.default_rng(k)
    x = (rng.integers(-4, 5, (6, dim))[rng.integers(0, 6, 150)] + rng.standard_normal((150, dim)) * 0.7) * scale
    x[5] = x[4]
    rows = [(int(i) if i != 40 else None, [float(v) for v in r]) for i, r in enumerate(x)] + [(3, [float(v) for v in x[3]])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert result(df, k=k, rounds=5, dim=dim) == plain(rows, k, 5, dim)


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, None), (2, []), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (6, [1.0]), (7, [1.0, 2.0, 3.0]), (8, [1e300, 0.0]),
            (9, [0.5, -0.5]), (9, [0.5, -0.5]), (None, [0.25, 0.001]), (10, [-0.001, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert result(df, k=3, rounds=2, dim=2) == plain(rows, 3, 2, 2)
    assert len(result(df, dim=2)) == 4  # fewer vectors than centroids
    wide = df.selectExpr("vec_id AS key", "embedding AS v", "1 AS cluster", "2 AS dist", "3 AS bound", "4 AS n", "5 AS c", "6 AS inertia")
    assert [tuple(r)[1:] for r in C.cluster(wide, k=3, rounds=2, dim=2, key="key", vec="v").orderBy("key", "cluster").collect()] == [
        tuple(r)[1:] for r in C.cluster(df, k=3, rounds=2, dim=2).orderBy("vec_id", "cluster").collect()
    ]
    assert C.cluster(df.limit(0), dim=2).count() == 0


def test_bounds_hold_and_are_tighter_than_the_move():
    rng = np.random.default_rng(1)
    below = 0
    for _ in range(200):
        dim = int(rng.integers(1, 6))
        centre, old = rng.standard_normal(dim), rng.standard_normal((1, dim)) * 3
        new, radius = old + rng.standard_normal((1, dim)) * rng.choice([0.1, 1, 4]), abs(rng.standard_normal())
        bound = C.nearer_by(centre, radius, old, new)[0]
        ball = rng.standard_normal((4000, dim))
        ball *= (rng.random((4000, 1)) ** 0.2) * radius / np.linalg.norm(ball, axis=1, keepdims=True)
        gain = np.linalg.norm(ball + centre - old, axis=1) - np.linalg.norm(ball + centre - new, axis=1)
        assert gain.max() <= bound + 1e-9
        assert bound <= np.linalg.norm(old - new) + 1e-9
        below += bound < 0.9 * np.linalg.norm(old - new)
    assert below > 50
    assert C.nearer_by(np.zeros(2), 1.0, np.ones((1, 2)) * 5, np.ones((1, 2)) * 5)[0] == 0


def test_few_vectors_are_scanned_again(spark):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((8, 16))[rng.integers(0, 8, 600)] * 3 + rng.standard_normal((600, 16)) * 0.3
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    scans = [r.scans for r in C.cluster(df, k=8, dim=16).collect()]
    assert np.mean(scans) < 4  # six times without bounds
