"""Ids and decoded texts against the tokenizers library."""

import hashlib
import struct

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from agentlake.llm import bpe, entries
from agentlake.llm.rows import table

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def pair():
    return bpe.Encoder(bpe.Automaton(PATH)), Tokenizer.from_file(PATH)


def ids(encoder, text):
    raw = encoder(text)
    return list(struct.unpack(f"<{len(raw) // 4}I", raw))


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("abthersing'sİΣσßÅé́你 \t\n\x1c\x85　.,!<|endoftext|>09½😀")), max_size=24))
def test_any_text(pair, text):
    encoder, tokenizer = pair
    want = tokenizer.encode(text, add_special_tokens=False).ids
    assert ids(encoder, text) == want
    assert encoder.decode(encoder(text)) == tokenizer.decode(want, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.data())
def test_joined_tokens(pair, data):
    encoder, tokenizer = pair
    some = st.sampled_from(sorted(encoder.a.vocab))
    text = "".join(t.removesuffix("</w>") for t in data.draw(st.lists(some, min_size=1, max_size=5)))
    assert ids(encoder, text) == tokenizer.encode(text, add_special_tokens=False).ids


def test_special_long_and_empty(pair):
    encoder, tokenizer = pair
    for text in ("", "<|startoftext|>x<|endoftext|>", "<|END", "a" * 30_000, "the, " * 5_000, "Σ" * 9):
        assert ids(encoder, text) == tokenizer.encode(text, add_special_tokens=False).ids


def test_nulls_repeats_and_clashing_names(spark):
    rows = [(1, None, "x"), (1, "The cat.", "y"), (1, "The cat.", "y"), (None, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = bpe.round_trip(docs, PATH).collect()
    assert sorted(r.n_tokens for r in out) == [0, 0, 3, 3]
    assert {r.decoded for r in out} == {"", "the</w> cat</w> .</w>"}
    assert bpe.round_trip(docs.limit(0), PATH).count() == 0


def test_query(spark, sf):
    tokenizer = Tokenizer.from_file(PATH)
    texts = {r.doc_id: r.text or "" for r in table(spark, sf, "documents").select("doc_id", "text").collect()}
    out = entries.QUERIES["op2_bpe"](spark, sf).collect()
    assert sorted(r.doc_id for r in out) == sorted(texts)
    for r in out:
        want = tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(want)}I", *want)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(tokenizer.decode(want, skip_special_tokens=False).encode()).hexdigest()
