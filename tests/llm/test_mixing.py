"""Targets against a direct computation; balance, limits and repeatability of what is taken."""

import random
import re

import pytest

from agentlake.llm import entries, mixing
from agentlake.llm.rows import table


def targets(by_source):
    names = sorted((s for s in by_source if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in by_source)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    want, full = 1.5 * sum(by_source.values()), set()
    while True:
        rest = sum(weight[s] for s in names if s not in full)
        factor = (want - sum(2 * by_source[s] for s in full)) / rest if rest else 0
        more = {s for s in names if s not in full and factor * weight[s] > 2 * by_source[s]}
        if not more:
            return {s: 2.0 * by_source[s] if s in full else factor * weight[s] for s in names}
        full |= more


def check(rows, texts):
    size = {k: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for k, (t, _) in texts.items()}
    by_source = {}
    for k, (_, s) in texts.items():
        by_source[s] = by_source.get(s, 0) + size[k]
    want = targets(by_source)
    taken, largest = {}, {}
    for r in rows:
        s = texts[r.doc_id][1]
        assert r.size == size[r.doc_id] and r.source_size == by_source[s]
        assert r.target == pytest.approx(want[s], rel=1e-9)
        assert r.taken <= 2 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[s] = taken.get(s, 0) + r.taken
        largest[s] = max(largest.get(s, 0), r.size)
    for s, n in taken.items():
        assert abs(n - want[s]) <= largest[s], s
    return sum(abs(n - want[s]) for s, n in taken.items()) / max(1, sum(want.values()))


def test_query(spark, sf):
    texts = {r.doc_id: (r.text, r.source) for r in table(spark, sf, "documents").collect()}
    rows = entries.QUERIES["op5_cube_mix"](spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    check(rows, texts)
    again = entries.QUERIES["op5_cube_mix"](spark, sf).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, again), key=str)


def test_several_rounds_are_close(spark, monkeypatch):
    monkeypatch.setattr(mixing, "GROUP", 8)
    rng = random.Random(3)
    texts = {i: ("w " * rng.choice([0, 1, 5, 9, 40]), rng.choice(["a", "b", "é", None, "a"])) for i in range(700)}
    docs = spark.createDataFrame([(k, t, s) for k, (t, s) in texts.items()], "doc_id long, text string, source string")
    out = mixing.mix(docs)
    out = out.withColumn("taken", out["size"] * out["times"])
    assert check(out.collect(), texts) < 0.01
    shuffled = mixing.mix(docs.repartition(7))
    assert sorted(map(tuple, mixing.mix(docs).collect()), key=str) == sorted(map(tuple, shuffled.collect()), key=str)


def test_nulls_repeats_empty(spark):
    rows = [(None, None, None)] * 3 + [(2**60 + 1, "a b", "s")] * 4 + [(5, "", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix(docs).collect()
    assert sorted((str(r.doc_id), r.source_size) for r in out) == sorted([("None", 0)] * 3 + [(str(2**60 + 1), 8)] * 4 + [("5", 0)])
    assert sum(r.size * r.times for r in out) == 12
    assert mixing.repeat(docs).where("source = 's'").count() == 6
    assert mixing.mix(docs.limit(0)).count() == 0


def test_large_documents_are_settled_first(spark):
    """Few documents of very different sizes: what is left to the draw is small."""
    rng = random.Random(12)
    texts = {i: ("w " * n, s) for i, (n, s) in enumerate((int(10 ** rng.uniform(0.3, 3.6)), s) for s in "abcdefgh" for _ in range(45))}
    docs = spark.createDataFrame([(k, t, s) for k, (t, s) in texts.items()], "doc_id long, text string, source string")
    misses = []
    for seed in range(3):
        taken, want = {}, {}
        for r in mixing.mix(docs, seed=seed).collect():
            taken[r.source] = taken.get(r.source, 0) + r.size * r.times
            want[r.source] = r.target
        misses += [abs(taken[s] - want[s]) / want[s] for s in want]
    assert max(misses) < 0.02, misses


def test_flight_keeps_sums_and_chances():
    for sizes in ([900, 40, 30, 30, 9, 5, 5, 2, 1, 0], [7] * 6, [9, 4, 4, 4], [5, 5, 1, 1], [3], []):
        for start in (0.3, 0.5, 0.85):
            mean = [0.0] * len(sizes)
            for seed in range(600):
                units = [[s, start] for s in sizes]
                left = mixing._flight(units, random.Random(f"{seed}"))
                assert len(left) <= 2
                assert sum(u[1] for u in units) == pytest.approx(start * len(sizes), abs=1e-6)
                assert sum(s * u[1] for s, u in zip(sizes, units)) == pytest.approx(start * sum(sizes), abs=1e-4)
                mean = [m + u[1] / 600 for m, u in zip(mean, units)]
            assert all(abs(m - start) < 0.08 for m in mean), (sizes, start, mean)
