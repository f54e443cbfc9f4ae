"""Links and components of vectors against all pairs."""

import numpy as np
import pytest

from agentlake.llm import embedding_dedup as E
from agentlake.llm import entries
from agentlake.plans.check import compare, connect


def test_query(spark, sf):
    name = "op1_embedding_pairs"
    ok, message, _ = compare(spark, connect(sf), sf, name, entries.QUERIES[name], entries.ORACLE[name])
    assert ok, message


@pytest.mark.parametrize("dim, slice_rows", [(64, 10_000), (64, 9), (20, 30), (3, 25)])
def test_all_pairs(spark, dim, slice_rows):
    rng = np.random.default_rng(dim)
    centre = rng.standard_normal((9, dim))
    x = (centre[rng.integers(0, 9, 240)] + rng.standard_normal((240, dim)) * rng.choice([0.05, 0.25, 0.5, 2], 240)[:, None]).astype(np.float32)
    x[7] = x[3]
    x[8] = x[3] * np.float32(4)
    rows = [(i, [float(v) for v in r], "x") for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, raw string")
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    link = u @ u.T >= 0.9
    np.fill_diagonal(link, False)
    label = np.arange(240)
    while True:
        new = np.minimum(label, np.where(link, label[None, :], 240).min(1))
        if (new == label).all():
            break
        label = new
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in E.near_duplicates(df, slice_rows=slice_rows).collect()}
    assert got == {i: (int(link[i].sum()), int(label[i]), bool(label[i] == i)) for i in range(240)}


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0, 0.0]), (8, [1.0, 0.1]),
            (8, [1.0, 0.1]), (None, [1.0, 0.0]), (9, [1.0, 0.0, 0.0]), (10, [-1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(((r.vec_id, r.n_links, r.component_id) for r in E.near_duplicates(df).collect()), key=str)
    want = [(k, 0, k) for k in (1, 2, 3, 4, 5, 6, 9, 10, None)] + [(7, 2, 7), (8, 2, 7), (8, 2, 7)]
    assert got == sorted(want, key=str)
    assert E.near_duplicates(df.limit(0)).count() == 0


def test_pivots_of_a_sample(spark, monkeypatch):
    """Pivots from a sample of 40 of 300 vectors, and a dimension the sample may lack: no link is lost."""
    monkeypatch.setattr(E, "SAMPLE", 40)
    monkeypatch.setattr(E, "PIVOTS", (3, 5))
    rng = np.random.default_rng(5)
    x = (rng.standard_normal((12, 40))[rng.integers(0, 12, 300)] + 0.3 * rng.standard_normal((300, 40))).astype(np.float32)
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(900, [1.0, 0.0]), (901, [1.0, 0.1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    want = {i: int(n) - 1 for i, n in enumerate((u @ u.T >= 0.9).sum(1))} | {900: 1, 901: 1}
    assert {r.vec_id: r.n_links for r in E.near_duplicates(df, slice_rows=20).collect()} == want


def test_one_cell_sees_each_pair():
    """Of two vectors within the radius exactly one visits the other's cell and is the nearer to the plane, or both share one."""
    rng = np.random.default_rng(2)
    x = rng.standard_normal((500, 6)) * 0.4
    budget = 0.2
    pivots = E.place_pivots(x, budget, 500)
    home, visits = E.homes_and_visits(x, pivots, budget)
    assert len(pivots) > 1
    for i, j in np.argwhere(np.triu(((x[:, None] - x[None]) ** 2).sum(-1) <= budget, 1)):
        if home[i] != home[j]:
            p, q = pivots[home[i]][None], pivots[home[j]][None]
            mine, other = E._lead(x[i][None], p, q)[0], E._lead(x[j][None], q, p)[0]
            assert visits[i, home[j]] if mine <= other else visits[j, home[i]]
