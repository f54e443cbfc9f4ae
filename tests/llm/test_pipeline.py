"""The stages against plain computations of their effects on the smallest table."""

import hashlib
import struct

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from agentlake.llm import mixing, secrets
from agentlake.llm.rows import table
from tests.llm.test_secrets import base
from tests.llm.test_simhash import plain_components, plain_fingerprint


def test_stages_and_run(spark, sf):
    docs = table(spark, sf, "documents")
    columns = docs.columns
    given = {r.doc_id: r for r in docs.collect()}
    out, results = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, out, sf)
        rows = out.collect()
        out = spark.createDataFrame(rows, out.schema)
        results[name] = rows
        if name != "tokens":
            assert out.columns == columns
    lang = {r.doc_id: r for r in results["language"]}
    gone = set(given) - set(lang)
    assert all(not any(c.isalpha() for c in given[k].text or "") for k in gone)
    group = plain_components({k: plain_fingerprint(r.text) for k, r in lang.items()})
    one = {r.doc_id for r in results["near_duplicates"]}
    assert one == set(group.values()) and len(results["near_duplicates"]) == len(one)
    clean = {r.doc_id: r.text for r in results["secret_spans"]}
    assert set(clean) == one
    assert not any(s.split(":")[0] in ("access", "hex") for t in clean.values() for s in base(t or ""))
    assert all(clean[k] == given[k].text for k in one if not secrets.find_parts(given[k].text or ""))
    times = {r.doc_id: r.times for r in mixing.mix(spark.createDataFrame(results["secret_spans"], docs.schema)).collect()}
    got = [r.doc_id for r in results["mixture"]]
    assert {k: got.count(k) for k in times} == times and max(times.values()) <= 2
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for r in results["tokens"]:
        ids = tokenizer.encode(clean[r.doc_id] or "", add_special_tokens=False).ids
        assert bytes(r.ids) == struct.pack(f"<{len(ids)}I", *ids) and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(bytes(r.ids)).hexdigest()
    whole = corpus_pipeline.run(spark, sf).select("doc_id", "ids_sha256").collect()
    assert sorted(map(tuple, whole)) == sorted((r.doc_id, r.ids_sha256) for r in results["tokens"])
