"""The paths for heavy keys and large sides give the same rows as plain loops."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from agentlake.operators import allocation, claims, neighbours, scans, scheduling, tfidf


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(5)
    rows = [(0 if i % 3 == 0 else rnd.randrange(40), i, rnd.randrange(-5, 20), rnd.random() < 0.1) for i in range(3000)]
    return rows, spark.createDataFrame(rows, "k long, seq long, v long, f boolean")


@pytest.mark.parametrize("hot_rows", [10, 500, 10**9])
@pytest.mark.parametrize("inclusive", [True, False])
def test_running_matches_a_loop(skewed, hot_rows, inclusive):
    rows, df = skewed
    got = scans.running(df, ["k"], ["seq"], scans.id_slice("seq", 64), {"s": F.col("v"), "n": F.lit(1)}, inclusive, hot_rows)
    total, count, want = defaultdict(int), defaultdict(int), {}
    for k, seq, v, _ in rows:
        before = (total[k], count[k])
        total[k] += v
        count[k] += 1
        want[seq] = (total[k], count[k]) if inclusive else before
    assert {r["seq"]: (r["s"], r["n"]) for r in got.collect()} == want


def test_lookback_crosses_blocks(skewed):
    rows, df = skewed
    seen, want = defaultdict(list), {}
    for k, seq, v, _ in rows:
        seen[k].append(v)
        want[seq] = (sum(seen[k][-3:]), seen[k][-3] if len(seen[k]) > 2 else None, len(seen[k]))
    out = {r["o"]: (r["s"], r["p"], r["no"]) for r in scans.lookback(
        df.withColumn("o", F.col("seq")), ["k"], ["o"], scans.id_slice("o", 64), {"s": ("sum", "v"), "p": ("lag", "v", 2)}, 2, seq="no", block=7).collect()}
    assert out == want


def test_file_order_numbers(spark):
    df = spark.range(0, 1000, 1, 7).select((F.col("id") * 3).alias("x"))
    got = sorted((r["x"], r["n"]) for r in scans.numbered_in_file_order(df, "n").collect())
    assert got == [(i * 3, i + 1) for i in range(1000)]


def test_paged_lists_are_whole(skewed):
    rows, df = skewed
    pages = scans.paged_lists(df, ["k"], ["seq"], scans.id_slice("seq", 64), F.col("seq"), page_rows=10).collect()
    mine = sorted((p["page"], p["items"]) for p in pages if p["k"] == 0)
    assert sum((p[1] for p in mine), []) == [s for k, s, _, _ in rows if k == 0] and max(p["n"] for p in pages) <= 10


def loop_allocate(lines, stock):
    left, orders, out = dict(stock), defaultdict(lambda: defaultdict(int)), {}
    for site, seq, item, q in lines:
        orders[(site, seq)][item] += q
    for (site, seq) in sorted(orders):
        need = orders[(site, seq)]
        ok = all(left.get((site, i), 0) >= q for i, q in need.items())
        if ok:
            for i, q in need.items():
                left[(site, i)] -= q
        out[(site, seq)] = ok
    return out


@pytest.mark.parametrize("hot_lines", [60, 10**9])
def test_allocation_matches_a_loop(spark, hot_lines):
    rnd = random.Random(3)
    lines = []
    for seq in range(260):
        site = 0 if seq % 2 else rnd.randrange(1, 6)
        for item in rnd.sample(range(4), rnd.choice([1, 2])):
            lines.append((site, seq, item, rnd.randrange(1, 30)))
    stock = {(s, i): rnd.randrange(0, 160) for s in range(6) for i in range(4) if (s + i) % 7}
    df = spark.createDataFrame(lines, "site long, seq long, item long, quantity long")
    st = spark.createDataFrame([(s, i, a) for (s, i), a in stock.items()], "site long, item long, amount long")
    got = allocation.allocate(df, st, hot_lines=hot_lines, block=16)
    assert {(r["site"], r["seq"]): r["accepted"] for r in got.collect()} == loop_allocate(lines, stock)


def brute(vecs, queries, k, metric):
    out = {}
    for q, qv in queries:
        scored = []
        for i, v in vecs:
            if metric == "l2":
                s = -round(float(((v - qv) ** 2).sum()), 9)
            else:
                n = np.linalg.norm(v) * np.linalg.norm(qv)
                s = round(float(v @ qv / n), 9) if n else float("-inf")
            scored.append((-s, i))
        out[q] = [i for _, i in sorted(scored)[:k]]
    return out


@pytest.mark.parametrize("metric", ["cosine", "l2"])
@pytest.mark.parametrize("max_carried", [1000, 5])
def test_nearest_is_exact(spark, monkeypatch, metric, max_carried):
    monkeypatch.setattr(neighbours, "CORPUS_BLOCK", 40)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 8)
    monkeypatch.setattr(neighbours, "CELLS", 64)
    rng = np.random.default_rng(1)
    vecs = [(i, rng.integers(-3, 4, 6).astype(np.float64)) for i in range(150)]
    vecs[7] = (7, np.zeros(6))
    vecs[9] = (9, vecs[8][1])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in vecs], "id long, vec array<float>")
    queries = [(i, v) for i, v in vecs if i % 7 == 1]
    q = df.filter("id % 7 = 1").select(F.col("id").alias("query_id"), "vec")
    got = defaultdict(list)
    for r in neighbours.nearest(df, q, 4, metric, max_carried).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append(r["id"])
    assert dict(got) == brute(vecs, queries, 4, metric)


def test_approximate_recall(spark):
    rng = np.random.default_rng(2)
    centers = rng.standard_normal((20, 16)) * 3
    vecs = [(i, centers[i % 20] + rng.standard_normal(16) * 0.3) for i in range(400)]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in vecs], "id long, vec array<float>")
    q = df.select(F.col("id").alias("query_id"), "vec")
    exact = {(r["query_id"], r["id"]) for r in neighbours.nearest(df, q, 3).collect()}
    near = {(r["query_id"], r["id"]) for r in neighbours.nearest_approximate(df, q, dim=16, k=3, tables=8, bits=6).collect()}
    assert len(exact & near) / len(exact) > 0.9


def test_tfidf_paths_agree(spark):
    rnd = random.Random(4)
    vocab = [f"w{i}" for i in range(60)]
    docs = spark.createDataFrame([(i, " ".join(rnd.choices(vocab, k=rnd.randrange(1, 30)))) for i in range(120)], "id long, text string")
    asked = spark.createDataFrame([(i, " ".join(rnd.choices(vocab, k=6))) for i in range(9)], "query_id long, text string")
    idf = tfidf.fit(docs, "id", "text")
    d, q = tfidf.transform(docs, "id", "text", idf), tfidf.transform(asked, "query_id", "text", idf)
    rows = lambda df: sorted((r["query_id"], r["id"], r["score"]) for r in df.collect())
    carried, joined = rows(tfidf.match(d, q, 0.2)), rows(tfidf.match(d, q, 0.2, max_postings=3))
    assert carried == joined and len(carried) > 20
    assert rows(tfidf.search(docs, asked, 0.2)) == carried


def test_similar_claims_pairs_and_counts(spark):
    rnd = random.Random(6)
    rows = [(i, rnd.randrange(6), rnd.choice("AB"), rnd.randrange(0, 40000)) for i in range(150)]
    df = spark.createDataFrame(rows, "claim_id long, patient_id long, code string, amount_cents long")
    want = {}
    for a in rows:
        for b in rows:
            d = abs(a[3] - b[3]) if a[3] > 0 else 10**9
            t = (5 if a[2] == b[2] else 0) + (3 if d < 5000 else 1 if d < 10000 else 0) + (1 if a[1] == b[1] else 0)
            if t >= 7 and a[0] != b[0]:
                want[(a[0], b[0])] = t / 10
    got = {(r["asked_id"], r["claim_id"]): r["similarity_score"] for r in claims.similar_claims(df, df).collect()}
    assert got == want
    tiers = defaultdict(lambda: defaultdict(int))
    for (a, b), t in want.items():
        if a != b:
            tiers[a][t] += 1
    for r in claims.similar_claim_counts(df).collect():
        t = tiers[r["claim_id"]]
        assert (r["n_same_patient"], r["n_other_patient"], r["n_same_patient_close"]) == (t[0.9], t[0.8], t[0.7])


def loop_tasks(tasks):
    left, order = list(tasks), []
    while left:
        if any(t["deadline"] == "urgent" or t["priority"] >= 8 for t in left):
            pick = max(left, key=lambda t: (t["priority"], -t["seq"]))
        else:
            pick = min(left, key=lambda t: (t["complexity"], t["seq"]))
        order.append(pick["seq"])
        left.remove(pick)
    return order


def loop_size(tasks):
    left, order = list(tasks), []
    while left:
        pick = min(left, key=lambda t: (t["complexity"], t["seq"])) if len(left) > 3 else max(left, key=lambda t: (t["priority"], -t["seq"]))
        order.append(pick["seq"])
        left.remove(pick)
    return order


def test_task_orders_match_loops(spark):
    rnd = random.Random(8)
    rows = [(b, b * 100 + s, rnd.randrange(1, 9), rnd.randrange(1, 11), rnd.choice(["urgent", "normal", "flexible"]))
            for b in range(40) for s in range(rnd.randrange(1, 9))]
    df = spark.createDataFrame(rows, "batch long, seq long, complexity long, priority long, deadline string")
    groups = defaultdict(list)
    for r in df.collect():
        groups[r["batch"]].append(r.asDict())
    for operator, loop in ((scheduling.order_deterministic, loop_tasks), (scheduling.order_by_size, loop_size)):
        got = defaultdict(dict)
        for r in operator(df).collect():
            got[r["batch"]][r["place"]] = r["seq"]
        for b, tasks in groups.items():
            assert [got[b][i] for i in sorted(got[b])] == loop(tasks), (operator, b)
            assert sorted(got[b]) == list(range(1, len(tasks) + 1))


def test_grants_match_a_loop(spark, skewed):
    rows, df = skewed
    out = scheduling.supply_grants(df.select("k", "seq", F.col("v").alias("want")), ["k"], "seq", 60)
    left, want = defaultdict(lambda: 60), {}
    for k, seq, v, _ in rows:
        g = min(max(min(v, 5), 0), left[k])
        left[k] -= g
        want[seq] = g
    assert {r["seq"]: r["granted"] for r in out.collect()} == want


def test_file_order_numbers_over_files_of_any_size(spark, tmp_path):
    sizes = {"a": 3, "b": 300, "c": 20, "d": 1}
    for name, n in sizes.items():
        (tmp_path / f"{name}.csv").write_text("x\n" + "".join(f'"{name}{k}"\n' for k in range(n)))
    df = spark.read.schema("x string").option("header", True).option("multiLine", True).csv(str(tmp_path))
    got = {r["x"]: r["n"] for r in scans.numbered_in_file_order(df, "n").collect()}
    want = [f"{name}{k}" for name, n in sizes.items() for k in range(n)]
    assert got == {x: i + 1 for i, x in enumerate(want)}
