"""Steps whose time or disk must not follow the size of a table, against plain versions."""

import math
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from agentlake.operators import claims as cl
from agentlake.operators import tfidf


def _tile(n, ids, patients, seed):
    rng = np.random.default_rng(seed)
    names = sorted(f"C{i:06d}" for i in rng.integers(0, ids, n))
    known = rng.random(n) < 0.9
    return names, rng.integers(0, 30_000, n), np.where(known, rng.integers(0, patients, n), 0), known


def _asked(n, ids, patients, seed):
    rng = np.random.default_rng(seed)
    who = [int(x) if x < patients + 2 else None for x in rng.integers(0, patients + 4, n)]
    names = [f"C{i:06d}" for i in rng.permutation(ids)[:n]]
    return pa.RecordBatch.from_pydict({"claim_id": names, "amount_cents": rng.integers(10_000, 20_000, n), "patient_id": pa.array(who, pa.int64())})


def test_a_tile_counts_and_lists_the_same_hits():
    for seed, (n, ids, patients) in enumerate([(300, 150, 5), (200, 1000, 400), (1, 3, 1), (80, 40, 1)]):
        names, amounts, who, known = _tile(n, ids, patients, seed)
        rows = _asked(min(ids, 120), ids, patients, seed + 9)
        for sound in (known, np.zeros(n, dtype=bool)):
            tile = cl._Tile(pa.array(names), amounts, who, sound)
            counts, hits = tile.counts(rows), tile.hits(rows)
            want = {9: [], 8: [], 7: []}
            for i, (name, amount, patient) in enumerate(zip(*(rows.column(c).to_pylist() for c in ("claim_id", "amount_cents", "patient_id")))):
                for j in range(n):
                    diff, same = abs(int(amounts[j]) - amount), bool(sound[j]) and patient == who[j]
                    tenths = 5 + (3 if diff < 5000 else 1 if diff < 10_000 else 0) + same
                    if tenths >= 7 and names[j] != name:
                        want[tenths].append((i, j))
            for t, pairs in want.items():
                assert list(zip(*(x.tolist() for x in hits[t]))) == pairs
                assert counts[t].tolist() == np.bincount([i for i, _ in pairs], minlength=rows.num_rows).tolist()


def test_counting_forms_no_pairs():
    n = 20_000
    tile = cl._Tile(pa.array([f"C{i:06d}" for i in range(n)]), np.arange(n) % 30_000, np.arange(n) % 3, np.ones(n, dtype=bool))
    rows = _asked(n, n, 3, 1)
    tracemalloc.start()
    found = tile.counts(rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(int(x.sum()) for x in found.values()) > n * n // 4 and peak < 1000 * n  # the pairs alone would be a byte each


def test_tasks_follow_the_tiles_and_not_the_bytes(spark):
    rows = [(f"C{i}", i % 7, "a", 20_000 + i, "public") for i in range(500)]
    df = spark.createDataFrame(rows, "claim_id string, patient_id long, code string, amount_cents long, privacy_level string")
    asked = df.filter(F.col("amount_cents") % 5 == 0)
    assert cl.similar_claims_list(asked, df, "agent").rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism
    assert cl.similar_claims_list(asked, df, "agent", tile=8).rdd.getNumPartitions() >= 3 * 500 // 32


def _texts(n, seed, extra=()):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(40)] + ["the", "About", "longword" * 12]
    chances = np.arange(len(words), 0, -1.0) / np.arange(len(words), 0, -1.0).sum()
    return [(i, " ".join(rng.choice(words, int(rng.integers(1, 14)), p=chances))) for i in range(n)] + list(extra)


ODD = [(3, "w1 w2 W1 zz"), (3, None), (None, "w3 w4"), (None, "w4 w39 yy"), (90, ""), (91, "the"), (92, None), (93, "w39 w39 w38 " + "longword" * 12)]


def _searched(docs, asked, threshold):
    """(query_id, id, score) by plain sums."""
    def counted(rows):
        found = defaultdict(Counter)
        for i, text in rows:
            found[i].update(w for w in (text or "").lower().split() if w not in tfidf.STOP_WORDS and len(w) > 1)
        return {i: c for i, c in found.items() if c}

    d, q = counted(docs), counted(asked)
    df = Counter(w for c in d.values() for w in c)
    unit = {}
    for name, side in (("d", d), ("q", q)):
        for i, c in side.items():
            w = {t: n * (math.log((1 + len(docs)) / (1 + df[t])) + 1) for t, n in c.items() if t in df}
            unit[name, i] = {t: x / math.sqrt(sum(y * y for y in w.values())) for t, x in w.items()}
    out = [(a, b, round(sum(x * unit["d", b].get(t, 0.0) for t, x in unit["q", a].items()), 6)) for a in q for b in d]
    return sorted((r for r in out if r[2] >= threshold), key=str)


@pytest.mark.parametrize("carried, chars, broadcast, at_once", [(1 << 19, 64, 200_000, 1 << 19), (7, 64, 200_000, 50), (1 << 19, 64, 1, 1), (0, 64, 1, 30)])
@pytest.mark.parametrize("odd", [True, False])
def test_search_is_the_same_whatever_tasks_hold(spark, monkeypatch, carried, chars, broadcast, at_once, odd):
    for name, value in (("CARRIED_WORDS", carried), ("CARRIED_CHARS", chars), ("BROADCAST_WORDS", broadcast), ("WORDS_AT_ONCE", at_once)):
        monkeypatch.setattr(tfidf, name, value)
    docs, asked = _texts(60, 1, ODD if odd else ()), _texts(12, 2, [(50, "w39 w38"), (51, "unknown"), (52, None)])
    tables = spark.createDataFrame(docs, "id long, text string").repartition(5), spark.createDataFrame(asked, "query_id long, text string")
    want = _searched(docs, asked, 0.2)
    assert len(want) > 20
    for most in (10**6, 1):
        got = sorted((tuple(r) for r in tfidf.search(*tables, 0.2, max_postings=most).collect()), key=str)
        assert [r[:2] for r in got] == [r[:2] for r in want] and all(abs(a[2] - b[2]) < 2e-6 for a, b in zip(got, want))


def test_words_are_neither_written_nor_moved_with_their_documents(spark, monkeypatch):
    docs = spark.createDataFrame(_texts(60, 1), "id long, text string").repartition(5)
    asked = spark.createDataFrame(_texts(12, 2), "query_id long, text string")
    kept, stable = [], tfidf.stable
    monkeypatch.setattr(tfidf, "stable", lambda df: kept.append(df.schema) or stable(df))
    tfidf.search(docs, asked, 0.2, max_postings=1).collect()
    assert not any({"id", "term", "tf"} <= set(x.names) for x in kept)
    vectors = [x for x in kept if x.names == ["id", "term", "w"]]
    assert [x["term"].dataType.simpleString() for x in vectors] == ["array<int>"]
    docs = docs.filter("text not like '%longword%'")  # words that tasks do not hold are joined
    plan = tfidf.transform(docs, "id", "text", tfidf.fit(docs, "id", "text"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan
