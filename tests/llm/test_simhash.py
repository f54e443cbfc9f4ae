"""Fingerprints and components against a direct computation over all pairs."""

import random

import pytest
import xxhash

from agentlake.llm import entries, simhash
from agentlake.llm.components import components
from agentlake.llm.rows import table


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(g, seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(values):
    """Smallest key reachable, for ``{key: fingerprint}``."""
    low = {}
    for k in sorted(values):
        low.setdefault(values[k], k)
    label = dict(low)
    changed = True
    while changed:
        changed = False
        for a in label:
            best = min(label[b] for b in label if (a ^ b).bit_count() <= 3)
            if best < label[a]:
                label[a], changed = best, True
    return {k: label[v] for k, v in values.items()}


def test_fingerprint_of_any_text():
    for text in (None, "", "\t\n", "A", "a B", "É a\x0bb C d", "x y z " * 20_000, "İ K ß"):
        assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_query(spark, sf):
    texts = {r.doc_id: r.text for r in table(spark, sf, "documents").select("doc_id", "text").collect()}
    want = {k: plain_fingerprint(t) for k, t in texts.items()}
    group = plain_components(want)
    out = entries.QUERIES["op7_simhash_groups"](spark, sf).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in out} == {k: (f"{v:016x}", group[k]) for k, v in want.items()}
    assert len(out) == len(texts)


@pytest.mark.parametrize("hot", [1, 10_000])
@pytest.mark.parametrize("ts", [None, (1, 1), (1, 0, 0), (0, 0, 1, -1)])
def test_links_for_any_thresholds(spark, hot, ts):
    rng = random.Random(5)
    seeds = [rng.getrandbits(64) for _ in range(6)]
    values = {0, 2**64 - 1}
    for _ in range(160):
        v = rng.choice(seeds)
        for _ in range(rng.randrange(5)):
            v ^= 1 << rng.randrange(64)
        values.add(v)
    want = {(a, b) for a in values for b in values if 0 < (a ^ b).bit_count() <= 3}
    fps = spark.createDataFrame([(simhash._signed(v),) for v in values], "fp long")
    if ts is None:
        parts = simhash.plan(fps)
        assert sum(t for _, t in parts) == 3 - len(parts) + 1 and sorted(b for p, _ in parts for b in p) == list(range(64))
    else:
        bits = list(range(64))
        rng.shuffle(bits)
        parts = [(bits[i :: len(ts)], t) for i, t in enumerate(ts)]
    rows = simhash.links(fps, parts, hot=hot).collect()
    got = {(r.a % 2**64, r.b % 2**64) for r in rows}
    assert len(got) == len(rows)
    assert got | {(b, a) for a, b in got} == want


def test_thresholds_by_trying_all():
    from itertools import product

    rng = random.Random(1)
    costs = [[0.0] + sorted(rng.random() * 100 for _ in range(4)) for _ in range(3)]
    best = min(sum(c[t + 1] for c, t in zip(costs, ts)) for ts in product(range(-1, 4), repeat=3) if sum(ts) == 1)
    assert simhash.thresholds(costs, 1)[0] == pytest.approx(best)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (300, 200), (200, 300)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)} | {200: 200, 300: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_nulls_repeats_empty(spark):
    rows = [(5, None, "x"), (3, "", "y"), (None, "a b c d", None), (9, "A b c d", "z"), (9, "A b c d", "z"), (None, None, "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    out = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()), key=str)
    assert out == sorted([(5, 3), (3, 3), (None, 9), (9, 9), (9, 9), (None, 3)], key=str)
    assert sorted(r.doc_id for r in simhash.first_of_each(docs).collect()) == [3, 9]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
