"""The forward sums against all segmentations written out; accuracy on held-out rows; odd rows."""

import math
import zlib

import numpy as np
import public_tokenizers
import pytest

from agentlake.llm import entries, langid
from agentlake.llm.rows import table

PATH = public_tokenizers.path("piece_bpe_32k.model")


def all_ways(s, table, k):
    if not s:
        return np.ones(k)
    total = np.zeros(k)
    for n in range(1, len(s) + 1):
        p = table.get(s[:n])
        if p is None and n == 1:
            p = (langid.UNKNOWN,) * k
        if p is not None:
            total += np.array(p) * all_ways(s[n:], table, k)
    return total


def test_forward_sums_all_segmentations():
    rng = np.random.default_rng(2)
    vocabulary = ["▁", "▁a", "▁ab", "a", "b", "c", "ab", "bc", "abc", "cab"]
    probabilities = rng.random((len(vocabulary), 2)) * [1, 0.01]
    model = langid.Model(["x", "y"], vocabulary, probabilities / len(vocabulary))
    for word in ("a", "abc", "abcabcab", "cabé", "ééé"):
        assert model.word(word) == pytest.approx(list(np.log(all_ways("▁" + word, model.table, 2))))
    long = model.word("abc" * 3000)
    assert all(map(math.isfinite, long)) and long[0] == pytest.approx(2 * model.word("abc" * 1500)[0], rel=0.02)


def test_expected_uses_of_pieces():
    probability = {"▁a": 0.2, "▁": 0.1, "a": 0.3, "b": 0.4, "ab": 0.05, "▁ab": 0.01}
    ways = {("▁ab",): 0.01, ("▁a", "b"): 0.08, ("▁", "a", "b"): 0.012, ("▁", "ab"): 0.005}
    want = {}
    for way, p in ways.items():
        for piece in way:
            want[piece] = want.get(piece, 0) + 3 * p / sum(ways.values())
    got = {}
    langid._expected("ab", 3.0, probability, {p[i:] for p in probability for i in range(len(p))}, got)
    assert got == pytest.approx(want)


def test_query_and_held_out_accuracy(spark, sf):
    rows = {r.doc_id: r for r in table(spark, sf, "documents").collect()}
    out = entries.QUERIES["op3_language"](spark, sf).collect()
    assert sorted(r.doc_id for r in out) == sorted(rows)
    held = [r for r in out if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)
    assert all(0 <= r.score <= 1 for r in out)
    right = [r.lang_pred == rows[r.doc_id].lang for r in held if rows[r.doc_id].lang and any(c.isalpha() for c in rows[r.doc_id].text or "")]
    assert len(right) > 20 and sum(right) / len(right) > 0.95


def test_odd_rows(spark):
    rows = [(i, "the cat and the dog" if i % 2 else "le chat et les chiens", "en" if i % 2 else "fr", "x") for i in range(40)]
    rows += [(None, "the", "en", "x"), (100, None, "en", "x"), (101, "12 ½ — ", None, "x"), (102, "", "fr", "x"), (103, "the cat " * 50_000, None, "x"), (103, "les chats", None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    out = langid.identify(docs, PATH, "doc_id").collect()
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append(r.lang_pred)
    assert by[100] == by[101] == by[102] == ["und"] and by[None] == ["en"] and sorted(by[103]) == ["en", "fr"]
    assert [r.held_out for r in out if r.doc_id is None] == [False]
    assert langid.identify(docs.limit(0), PATH, "doc_id").count() == 0
    unlabelled = docs.withColumn("lang", docs["lang"].substr(9, 1)).where("false")
    assert langid.train(unlabelled, PATH).languages == []
    kept = langid.kept_languages(docs, PATH)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()}.isdisjoint({100, 101, 102})
