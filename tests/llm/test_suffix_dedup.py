"""Removed bytes against all strings written out; the sorted suffixes against a plain sort."""

import hashlib
import random

import numpy as np
import pandas as pd
import pytest

from agentlake.llm import entries
from agentlake.llm import suffix_dedup as S
from agentlake.llm.rows import table


def plain(texts, n=S.LENGTH):
    """``{key: (n_bytes, n_removed, n_spans, digest)}`` of rows ``(key, text)``."""
    data = [(t or "").encode() for _, t in texts]
    times = {}
    for d in data:
        for i in range(len(d) - n + 1):
            times[d[i : i + n]] = times.get(d[i : i + n], 0) + 1
    out = []
    for (key, _), d in zip(texts, data):
        gone = np.zeros(len(d) + 1, bool)
        for i in range(len(d) - n + 1):
            if times[d[i : i + n]] > 1:
                gone[i : i + n] = True
        spans = int((gone[:-1] & ~gone[1:]).sum())
        kept = np.frombuffer(d, np.uint8)[~gone[:-1]].tobytes()
        out.append((key, len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(rows):
    return sorted(((r.doc_id, r.n_bytes, S_removed(r), len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest()) for r in rows), key=str)


def S_removed(r):
    return sum(s.end - s.begin for s in r.spans)


def test_query(spark, sf):
    texts = [(r.doc_id, r.text) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    out = entries.QUERIES["op8_suffix_repeats"](spark, sf).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out), key=str) == plain(texts)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abé") for _ in range(rng.randrange(1, 7)))
    passages = [" ".join(word() for _ in range(n)) for n in (30, 45, 60, 150)] + ["ab" * 180, "x" * 700]
    out = []
    for k in range(60):
        parts = []
        for _ in range(rng.randrange(5)):
            p = rng.choice(passages)
            cut = rng.randrange(len(p))
            parts.append(rng.choice([p, p[cut:], p[:cut], " ".join(word() for _ in range(40))]))
        out.append((k, "".join(parts)))
    return out + [(100, None), (101, ""), (102, out[3][1]), (103, out[5][1]), (None, passages[3]), (103, out[5][1])]


@pytest.mark.parametrize("hot", [10_000, 2, 0])
def test_all_strings(spark, hot):
    texts = corpus(hot)
    docs = spark.createDataFrame([(k, t, "x") for k, t in texts], "doc_id long, text string, uid string")
    assert found(S.remove_repeats(docs, "doc_id", hot=hot).collect()) == plain(texts)


@pytest.mark.parametrize("hot, chunk", [(10_000, 700), (10_000, 90), (0, 700)])
def test_strings_on_both_sides_of_a_chunk(spark, hot, chunk):
    rng = random.Random(chunk)
    new = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    passage = new(260)
    texts = [(1, new(5_000)), (2, new(1_500) + passage + new(2_000)), (3, new(340) + passage + new(390) + passage), (4, None), (5, new(900))]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    assert found(S.remove_repeats(docs, "doc_id", hot=hot, chunk=chunk).collect()) == plain(texts)


def test_a_long_text_without_repeats_stays_whole(spark):
    text = np.random.default_rng(8).integers(97, 123, S.CHUNK + 3_000).astype(np.uint8).tobytes().decode()
    row = S.remove_repeats(spark.createDataFrame([(1, text)], "doc_id long, text string"), "doc_id").first()
    assert row.spans == [] and bytes(row.kept).decode() == text


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert S.remove_repeats(docs, "doc_id").count() == 0


def test_induction_by_a_plain_comparison():
    rng = np.random.default_rng(4)
    length, gram = 24, 4
    rows = []
    for key in range(6):
        base = rng.integers(97, 99, 60).astype(np.uint8).tobytes()
        for _ in range(rng.integers(1, 12)):
            b = bytearray(base)
            for _ in range(rng.integers(0, 3)):
                b[rng.integers(0, 60)] = 99
            left, right = bytes(b)[int(rng.integers(0, 30)) : 30][-(length - gram) :][::-1], bytes(b)[30 : 30 + int(rng.integers(4, length + 1))]
            rows.append((key, left, right))
    rows.sort(key=lambda r: (r[0], r[2]))
    got = S.repeated_starts(np.array([r[0] for r in rows]), [r[1] for r in rows], [r[2] for r in rows], length, gram)

    def string(r, back):
        s = r[1][::-1] + r[2]
        p = len(r[1]) - back
        return s[p : p + length] if p >= 0 and len(s) >= p + length else None

    for back in range(length - gram + 1):
        for i, r in enumerate(rows):
            s = string(r, back)
            want = s is not None and any(j != i and q[0] == r[0] and string(q, back) == s for j, q in enumerate(rows))
            assert got[i, back] == want


def test_anchors_follow_content():
    rng = np.random.default_rng(0)
    body = rng.integers(97, 123, 3000).astype(np.uint8)
    h, at, first, last = S.anchors(body)
    assert first[0] == 0 and last[-1] == len(body) - S.LENGTH and (first[1:] == last[:-1] + 1).all()
    other = np.concatenate([rng.integers(97, 123, 777).astype(np.uint8), body])
    h2, at2, *_ = S.anchors(other)
    assert set(zip(h.tolist(), (at + 777).tolist())) <= set(zip(h2.tolist(), at2.tolist()))


def test_batches_of_whole_groups(monkeypatch):
    rng = random.Random(8)
    rows = []
    for key in range(30):
        base = bytes(rng.choice(b"ab") for _ in range(S.LENGTH))
        for k in range(rng.randrange(1, 9)):
            rows.append((key, f"u{k}", 1000 + k, 0, 0, b"", base if rng.random() < 0.6 else base[: rng.randrange(40, 200)]))
    rows.sort(key=lambda r: (r[0], r[6]))
    frame = pd.DataFrame(rows, columns=["h", "uid", "at", "low", "high", "left", "right"])

    def runs(batch, step):
        monkeypatch.setattr(S, "BATCH", batch)
        parts = [frame.iloc[i : i + step] for i in range(0, len(frame), step)]
        return sorted(tuple(r) for out in S._induce(iter(parts)) for r in out.itertuples(index=False))

    whole = runs(10_000, 1_000)
    assert whole and runs(5, 3) == whole == runs(1, 1) == runs(20, 50)


def test_chunks_hold_every_string_once(monkeypatch):
    monkeypatch.setattr(S, "CHUNK", 37)
    for size in (0, 5, S.LENGTH, S.LENGTH + 36, S.LENGTH + 37, 900):
        starts = []
        for begin, part in S._chunks("x" * size):
            starts += range(begin, begin + max(0, len(part) - S.LENGTH + 1))
        assert starts == list(range(max(0, size - S.LENGTH + 1)))
