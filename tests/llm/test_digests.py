"""Fingerprints against a plain rendering of their rules, window by window."""

import random
from collections import Counter
from hashlib import sha256
from math import log2

import numpy as np
import pytest
from pyspark.sql import functions as F

from agentlake.llm import digests as D
from agentlake.llm import entries

SHARE = [round(64 * c * log2(c)) if c else 0 for c in range(D.WINDOW + 1)]


def level(window: bytes) -> int:
    return (SHARE[-1] - sum(SHARE[c] for c in Counter(window).values())) * D.LEVELS // SHARE[-1]


def chosen(text: bytes, rank) -> list[bytes]:
    """The feature windows of a text in order, each once."""
    if len(text) < D.WINDOW:
        return [text] if text else []
    r = [rank[level(text[i : i + D.WINDOW])] for i in range(len(text) - D.WINDOW + 1)]
    votes = Counter()
    for i in range(1 - D.NEIGHBOURS, len(r)):
        near = range(max(0, i), min(len(r), i + D.NEIGHBOURS))
        votes[min(near, key=lambda j: (r[j], j))] += 1
    return list(dict.fromkeys(text[i : i + D.WINDOW] for i in range(len(r)) if votes[i] >= D.VOTES))


def mixed(f: bytes) -> int:
    short = len(f) < D.WINDOW
    words = f.ljust(D.WINDOW, b"\0") + (len(f).to_bytes(8, "little") if short else b"")
    h, mask = 0x9E3779B97F4A7C15, (1 << 64) - 1
    for i in range(0, len(words), 8):
        h = (h ^ int.from_bytes(words[i : i + 8], "little")) * 0xBF58476D1CE4E5B9 & mask
        h ^= h >> 29
        h = h * 0x94D049BB133111EB & mask
        h ^= h >> 32
    return h


def plain(text: bytes, rank) -> bytes:
    found, out = chosen(text, rank), b""
    for i in range(0, len(found), D.PER_FILTER):
        bits = [0] * D.BITS
        for f in found[i : i + D.PER_FILTER]:
            for k in range(D.HASHES):
                bits[(mixed(f) >> 12 * k) % D.BITS] = 1
        out += int("".join(map(str, bits)), 2).to_bytes(D.BITS // 8, "big")
    return out


def corpus(n, seed=1):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghijklmnoprstuvwyzäé") for _ in range(r.randint(1, 9)))
    texts = [" ".join(word() for _ in range(r.choice([0, 1, 3, 20, 90, 400]))) for _ in range(n)]
    return texts + [texts[-1], "a" * 500, "-" * 40 + "=" * 90, "x", ""]


def test_levels_counts_and_ranks():
    data = [t.encode() for t in corpus(12)]
    counts = D.level_counts(data)
    want = Counter(level(t[i : i + D.WINDOW]) for t in data for i in range(len(t) - D.WINDOW + 1))
    assert {i: n for i, n in enumerate(counts.tolist()) if n} == dict(want)
    rank = D.ranks(counts)
    assert sorted(rank) == list(range(D.LEVELS + 1)) and rank[: D.WEAK].min() > rank[D.WEAK :].max()
    strong = sorted((want.get(i, 0), -i) for i in range(D.WEAK, D.LEVELS + 1))
    assert [-i for _, i in strong] == sorted(range(D.WEAK, D.LEVELS + 1), key=lambda i: rank[i])


@pytest.mark.parametrize("piece", [1 << 20, 300])
def test_fingerprints(monkeypatch, piece):
    monkeypatch.setattr(D, "PIECE", piece)  # long texts in pieces, with equal results
    data = [t.encode() for t in corpus(25, 3)]
    rank = D.ranks(D.level_counts(data))
    assert D.fingerprints(data, rank) == [plain(t, rank) for t in data]
    assert D.fingerprints([], rank) == []


def test_likeness():
    r = random.Random(4)
    a, b = (bytes(r.choice(b"abcdefghijkl mnopqrst") for _ in range(30_000)) for _ in range(2))
    rank = D.ranks(D.level_counts([a, b]))
    fa, fb, half, part = D.fingerprints([a, b, a[:15_000] + b[:15_000], a[9000:20_000]], rank)
    assert D.likeness(fa, fa) == 1 and D.likeness(fa, fb) < 0.02
    assert 0.35 < D.likeness(fa, half) < 0.65 and D.likeness(fa, half) == D.likeness(half, fa)
    assert D.likeness(fa, part) > 0.3
    assert D.likeness(b"", b"") == 1 and D.likeness(b"", fa) == 0 == D.likeness(fa, b"")


def expected(rows, rank):
    """rows: (key, text) in order."""
    out = []
    for i, (key, text) in enumerate(rows):
        text, following = text or "", rows[(i + 1) % len(rows)][1] or ""
        edited = text[: len(text) - len(text) // 2] + following[: len(text) // 2]
        f, e, n = (plain(t.encode(), rank) for t in (text, edited, following))
        out.append((key, len(text), sha256(edited.encode()).hexdigest(), f, e, D.likeness(f, e), D.likeness(f, n)))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r[0], r[1], r[2], bytes(r[3]), bytes(r[4]), r[5], r[6]) for r in df.collect()), key=str)


def test_spliced_rows(spark):
    rows = list(enumerate(corpus(60, 9)))
    rows[7] = (7, None)
    df = spark.createDataFrame([(i - 5, t, "?", 1, 2) for i, t in rows], "doc_id long, text string, part string, first int, fingerprint int").repartition(7)
    rank = D.ranks(D.level_counts([(t or "").encode() for _, t in rows]))
    assert (D.rarity(df) == rank).all()
    assert rows_of(D.spliced(df)) == expected([(i - 5, t) for i, t in rows], rank)


def test_odd_tables(spark):
    one = spark.createDataFrame([(1, "word " * 50)], "doc_id long, text string")
    (r,) = D.spliced(one).collect()
    assert r.near_next == 1 and r.edited_sha256 == sha256((("word " * 50)[:125] * 2).encode()).hexdigest()
    assert D.spliced(one.limit(0)).count() == 0
    same = spark.createDataFrame([(None, None), (None, "text"), (4, "text"), (4, "text"), (4, "")], "doc_id long, text string")
    got = D.spliced(same).collect()
    assert len(got) == 5 and len({bytes(r.fingerprint) for r in got if r.n_chars == 4}) == 1


def test_query(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()]
    rank = D.ranks(D.level_counts([(t or "").encode() for _, t in rows]))
    want = [(*r[:3], r[3].hex(), r[4].hex(), *r[5:]) for r in expected(rows, rank)]
    assert sorted((tuple(r) for r in entries.QUERIES["op13_improbable_digest"](spark, sf).collect()), key=str) == want


def test_alike_column(spark):
    df = spark.createDataFrame([(1, "one two three " * 20, "one two three " * 20), (2, "abc" * 40, "xyz" * 50)], "id long, a string, b string")
    rank = np.arange(D.LEVELS + 1)
    out = df.select("id", D.alike(D.fingerprint(F.col("a"), rank), D.fingerprint(F.col("b"), rank)).alias("s")).orderBy("id").collect()
    assert out[0].s == 1 and out[1].s == 0
