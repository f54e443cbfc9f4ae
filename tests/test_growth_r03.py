"""Steps whose memory, moved rows or files must not follow the size of a table, against plain versions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from agentlake.functions import text as tx
from agentlake.operators import claims as cl
from agentlake.operators import tfidf
from agentlake.plans import storage_queries


def _claims(spark, n=400, seed=1):
    rng = np.random.default_rng(seed)
    row = lambda i: (f"C{i}", int(rng.integers(0, 8)), "ab"[int(rng.integers(0, 2))], int(rng.integers(0, 60_000)), "public")
    rows = [row(i) for i in range(n)]
    rows += [("C5", 1, "a", 20_000, "agent"), ("D1", None, "a", 21_000, "public"), ("D2", 1, None, 21_000, "public"), ("D3", 1, "a", None, "public"),
             (None, 1, "a", 21_500, "public"), ("D4", 1, "a", 0, "public"), ("D5", 1, "a", -4000, "public"), ("D6", 1, "a", 20_500, "admin")]
    return spark.createDataFrame(rows, "claim_id string, patient_id long, code string, amount_cents long, privacy_level string")


@pytest.mark.parametrize("tile", [20, 4096])
def test_listed_claims_are_the_numbered_pairs(spark, tile):
    df = _claims(spark)
    got = sorted(tuple(r) for r in cl.similar_claims_list(df, df, "agent", tile=tile).collect())
    pairs = [tuple(r) for r in cl.similar_claims(df, df.filter("privacy_level <> 'admin'")).collect()]
    want, seen = [], {}
    for a, c, s in sorted(pairs, key=lambda r: (r[0], -r[2], r[1])):
        seen[a] = seen.get(a, 0) + 1
        want.append((a, c, s, seen[a]))
    assert got == sorted(want) and {s for _, _, s, _ in got} == {0.7, 0.8, 0.9}
    assert any(a == "C5" for a, *_ in got) and any(c == "D1" for _, c, *_ in got)


def test_pairs_are_not_sorted_or_moved(spark):
    df = _claims(spark, 50).filter("claim_id <> 'C5'")
    plan = cl.similar_claims_list(df, df, "agent")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("MapInArrow") and "Join" not in plan


def test_counts_of_light_keys_need_no_marks(spark):
    hist = spark.createDataFrame([(k, v, n) for k in (1, 2, None) for v, n in ((-3, 1), (0, 2), (5, 1), (9, 4))] + [(7, None, 3)], "k long, v long, n long")
    one, other = (
        sorted(map(str, cl.counts_within(hist, ["k"], "v", {"a": 4, "b": 100}, light=light).collect())) for light in (256, 0)
    )
    assert one == other and len(one) == 12
    assert "explode" not in cl.counts_within(hist, ["k"], "v", {"a": 4})._jdf.queryExecution().optimizedPlan().toString()


def test_chunks_leave_in_bounded_batches(spark, monkeypatch):
    monkeypatch.setattr(tx, "CHARS_AT_ONCE", 300)
    monkeypatch.setattr(tx, "ROWS_AT_ONCE", 3)
    texts = ["word " * n for n in (0, 5, 400, 1, 90)] * 3 + [None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = sorted(tuple(r) for r in tx.chunk_text(docs, "doc_id", "text", size=100, overlap=20).collect())
    want = []
    for i, t in enumerate(texts):
        if t is not None:
            t = t.strip()
            want += [(i, n, t[a:b], b - a) for n, (a, b) in enumerate(tx.cut_points(t, 100, 20, 50))]
    assert got == sorted(want)


def test_scores_are_held_in_bounded_pieces(spark, monkeypatch):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(30)]
    text = lambda: " ".join(rng.choice(words, 12))
    docs = spark.createDataFrame([(i, text()) for i in range(60)] + [(99, None)], "id long, text string")
    asked = spark.createDataFrame([(i, text()) for i in range(20)], "query_id long, text string")
    run = lambda: sorted(tuple(r) for r in tfidf.search(docs, asked, 0.2).collect())
    whole, most, count = run(), [], np.bincount
    monkeypatch.setattr(tfidf, "CELLS", 64)
    small = run()
    assert small == whole and len(whole) > 20
    idf = tfidf.fit(docs, "id", "text")
    d, q = (tfidf.transform(x, k, "text", idf) for x, k in ((docs, "id"), (asked, "query_id")))
    rows = [r for r in q.select(F.col("id").alias("query_id"), F.explode("ws").alias("x")).select("query_id", "x.*").collect()]

    class Held:  # the batch function, run here
        schema = d.schema

        def mapInArrow(self, f, schema):
            import pyarrow as pa

            monkeypatch.setattr(np, "bincount", lambda c, w, minlength: most.append(max(len(c), minlength)) or count(c, w, minlength=minlength))
            ws = [{"id": r.id, "ws": [x.asDict() for x in r.ws]} for r in d.collect()]
            return list(f([pa.RecordBatch.from_pylist(ws)]))

    monkeypatch.setattr(tfidf, "CELLS", 400)
    tfidf._carried(Held(), rows, 0.2, False, "")
    assert len(most) > 5 and max(most) <= 400


def test_more_text_makes_more_files(spark, tmp_path, monkeypatch):
    rows = [(i, "en", "x\n" * 500) for i in range(200)]
    spark.createDataFrame(rows, "doc_id long, lang string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(storage_queries, "FILE_BYTES", 10_000)
    paths, path = [], storage_queries.files.scratch_path
    monkeypatch.setattr(storage_queries.files, "scratch_path", lambda s, n: paths.append(path(s, n)) or paths[-1])
    out = storage_queries.file_order_ids(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.row_id) for r in out) == [(i, i + 1) for i in range(200)]
    import glob

    assert len(glob.glob(f"{paths[0]}/*.csv")) > 10
