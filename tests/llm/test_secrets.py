"""Base spans against a plain reading of the rule; links on texts made for them."""

import hashlib
import re

from agentlake.llm import entries, secrets
from agentlake.llm.rows import table

RULES = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
    "access": (re.compile("AKIA[A-Z0-9]+"), 0, 20),
    "hex": (re.compile("[0-9a-f]+"), 0, 24),
}


def base(text):
    found = []
    for rank, (kind, (pattern, group, least)) in enumerate(RULES.items()):
        found += [(m.start(), rank, kind, m.end()) for m in pattern.finditer(text) if len(m[group]) >= least]
    return [f"{k}:{s}:{e}" for s, _, k, e in sorted(found)]


def test_query(spark, sf):
    texts = {r.doc_id: r.text or "" for r in table(spark, sf, "documents").select("doc_id", "text").collect()}
    out = entries.QUERIES["op4_secret_links"](spark, sf).collect()
    assert sorted(r.doc_id for r in out) == sorted(texts)
    for r in out:
        want = base(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s.startswith(k) for s in want) for k in RULES]
        assert [s for s in r.spans.split(",") if s.split(":")[0] in RULES] == want


HARD = "é😀 PassWord\" = 'abc123, ſecret=zzzzzzz toKen:abcdef AKIA" + "A1" * 9 + "z " + "0f" * 12 + "G" + "ab" * 11 + " secret=" + "0a" * 13


def spans(spark, *texts):
    rows = [(i, t, "x") for i, t in enumerate(texts)]
    out = secrets.scan(spark.createDataFrame(rows, "doc_id long, text string, spans string")).collect()
    return [[tuple(s) for s in r.spans] for r in sorted(out, key=lambda r: r.doc_id)]


def test_code_points_and_case(spark):
    got = [f"{k}:{s}:{e}" for k, s, e in spans(spark, HARD)[0] if k in RULES]
    assert got == base(HARD) and len(got) >= 5


def test_links(spark):
    alone, pair, far, server = spans(
        spark, "password = ab1", "user = bob; password = ab1", "user = bob; " + "x " * 200 + "password = ab1",
        "host 10.1.2.3:22 login: bob passwd: abc",
    )
    assert alone == [] and far == []
    assert [k for k, *_ in pair] == ["account", "weak_secret"]
    assert [k for k, *_ in server] == ["endpoint", "account", "weak_secret"]


def test_links_over_block_edges_and_with_strong_parts(spark):
    for shift in (500, 505, 512, 1020):
        text = "z " * (shift // 2) + "login: bob " + "secret = abcdef123"
        assert [k for k, *_ in spans(spark, text)[0]] == ["account", "assign"]


def test_nulls_repeats_empty(spark):
    rows = [(None, None), (None, "login: bob passwd: abc"), (None, "login: bob passwd: abc"), (1, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = secrets.scan(docs).collect()
    assert sorted(len(r.spans) for r in out) == [0, 0, 2, 2]
    assert secrets.scan(docs.limit(0)).count() == 0
    red = sorted((r.text or "") for r in secrets.redact(docs).collect())
    assert red == ["", "", "[ACCOUNT] [WEAK_SECRET]", "[ACCOUNT] [WEAK_SECRET]"]


def test_very_long_text(spark):
    text = "login: bob passwd: abc " + "a " * 400_000 + "f" * 100_000
    assert len(spans(spark, text)[0]) == 3


def test_long_weak_parts_are_whole(spark):
    url, name = "https://db.example.org/?" + "q=1&" * 400 + "end", "bob" * 40
    text = f"login: {name} passwd: abc {url} token=xyz after"
    want = [("account", f"login: {name}"), ("weak_secret", "passwd: abc"), ("endpoint", url), ("weak_secret", "token=xyz")]
    assert [(k, text[a:b]) for k, a, b in spans(spark, text)[0]] == want
    red = secrets.redact(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().text
    assert red == "[ACCOUNT] [WEAK_SECRET] [ENDPOINT] [WEAK_SECRET] after"
