"""Rule counts against plain Python; host verdicts; the query against its SQL."""

import random

import pytest

from agentlake.llm import entries, quality
from agentlake.plans.check import compare, connect


def plain(text):
    text = text or ""
    spaces = " \t\n\x0b\x0c\r"
    for c in spaces[1:]:
        plain_text = text.replace(c, " ") if c == "\t" else plain_text.replace(c, " ")
    words = [w for w in plain_text.split(" ") if w]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = {}
    for w in windows:
        times[w] = times.get(w, 0) + 1
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if x.strip(spaces)]
    n = len(words)
    return (n, sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), n < 10 or 100 * len(covered) > 20 * n)


def test_query(spark, sf):
    name = "op6_host_rules"
    ok, message, _ = compare(spark, connect(sf), sf, name, entries.QUERIES[name], entries.ORACLE[name])
    assert ok, message
    plan = entries.QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_counts_of_any_text(spark):
    rng = random.Random(4)
    texts = [None, "", " \t", "\x0b\x0c", "a", "a b c d e", "a b c d e a b c d e", "x " * 40, "é ü  z\n\n#*$\n#*$\r\n #*$", "a b " * 30_000]
    texts += ["".join(rng.choice(["a", "b", "c d", " ", "\n", "e f g h i ", "#"]) for _ in range(rng.randrange(120))) for _ in range(150)]
    docs = spark.createDataFrame([(i, t, "s", 1) for i, t in enumerate(texts)], "doc_id long, text string, source string, words int")
    got = {r.doc_id: tuple(r)[1:] for r in quality.rule_counts(docs, "doc_id").collect()}
    assert got == {i: plain(t) for i, t in enumerate(texts)}


def test_hosts_are_shrunk_and_refused(spark):
    good, bad = "one two three four five six seven eight nine ten eleven", "short"
    rows = [(i, good if i % 10 else bad, "fine") for i in range(100)]
    rows += [(200 + i, bad if i % 50 else good, "foul") for i in range(100)]
    rows += [(400, bad, "single"), (401, good, None), (401, good, None), (None, good, "foul")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    counts = quality.rule_counts(docs, "doc_id", "source")
    rates = {r.source: r.shrunk_rate for r in quality.host_rates(counts, "source").collect()}
    m = (10 + 98 + 1) / 202
    assert rates["foul"] > 0.9 and rates["fine"] < 0.2 and m < rates["single"] < 1
    out = quality.judge(docs, "doc_id").collect()
    assert len(out) == len(rows)
    kept = [r.doc_id for r in out if r.kept]
    assert sorted(k for k in kept if k is not None and k < 200) == [i for i in range(100) if i % 10]
    assert kept.count(401) == 2 and None not in kept and not any(200 <= k < 300 for k in kept if k is not None)
    assert quality.judge(docs.limit(0), "doc_id").count() == 0
    one = quality.judge(docs.where("source = 'fine'"), "doc_id").collect()
    assert all(r.shrunk_rate == pytest.approx(0.1) for r in one)


def test_weaker_rules_count_by_host(spark, tmp_path):
    """The verdict of hosts by every rule, in the operator and in SQL over the same rows."""
    prose = "one two three four five six seven eight nine ten {}"
    marks = "a### b$$$ c%% d&& e** f|| g<> h## i$# j%% {}"
    lines = "one two three {0}\nsame line\nfour five six {0}\nsame line\nten\nten\nten\nseven eight nine {0}"
    apart = "a b c d e f g h i j k l {}"
    rng = random.Random(6)
    rows = []
    for host, text, share in [("prose", prose, 0), ("tables", marks, 0.45), ("lists", lines, 0.45), ("letters", apart, 0.45), ("dump", marks, 0.9), ("tidy", marks, 0.05)]:
        rows += [(text if rng.random() < share else prose).format(i % 7) for i in range(400)]
        rows[-400:] = [(len(rows) - 400 + i, host, t) for i, t in enumerate(rows[-400:])]
    rows += [(9001, None, marks.format(1)), (9002, "prose", marks.format(1)), (9003, "tables", "short"), (9004, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    kept = {r.doc_id: r.kept for r in quality.judge(docs, "doc_id").collect()}
    for k, host, t in rows[:2400]:
        odd = t[:10] != prose[:10] or "\n" in t
        assert kept[k] == (host != "dump" and not (odd and host in ("tables", "lists", "letters"))), (host, t)
    assert [kept[k] for k in (9001, 9002, 9003, 9004)] == [True, True, False, False]

    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    name = "op6_host_rules"
    ok, message, _ = compare(spark, con, str(tmp_path), name, entries.QUERIES[name], entries.ORACLE[name])
    assert ok, message
