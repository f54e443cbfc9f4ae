"""Sources and sinks, model calls, retrieval helpers and streams on small inputs."""

import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from agentlake.operators import evals, fulfil, ledger, memory, models, rag
from agentlake.sources import collections, files, sampling
from agentlake.streaming import jobs

TXN = "txn_id long, item string, txn_type string, units long, price decimal(18,2), txn_date date"


def test_multiline_csv_with_row_ids(spark, tmp_path):
    (tmp_path / "q.csv").write_text('job,need_size,event,request,request_date\nteacher,small,show,"two\nlines, ""quoted""",4/1/25\nclerk,large,party,one,04/02/25\n')
    rows = files.read_requests(spark, str(tmp_path), row_id="id").orderBy("id").collect()
    assert [(r["id"], r["job"]) for r in rows] == [(1, "teacher"), (2, "clerk")]
    assert rows[0]["request"] == 'two\nlines, "quoted"'


def test_json_documents_use_the_file_stem(spark, tmp_path):
    for i, name in ((1, "Pikmin"), (2, "Tetris")):
        (tmp_path / f"{i:03d}.json").write_text(json.dumps({"Name": name, "Platform": "P", "Year": 1990 + i}, indent=2))
    docs = files.read_json_documents(spark, str(tmp_path), "Name string, Platform string, Year int", "[{Platform}] {Name} ({Year})").orderBy("id").collect()
    assert [(d["id"], d["content"]) for d in docs] == [("001", "[P] Pikmin (1991)"), ("002", "[P] Tetris (1992)")]
    assert docs[0]["metadata"]["Year"] == "1991"


def test_pages_chunks_embeddings_results(spark, tmp_path):
    (tmp_path / "pages").mkdir()
    (tmp_path / "pages" / "a.bin").write_bytes(b"one\x0c  \x0cthree")
    got = files.read_page_documents(spark, str(tmp_path / "pages"), lambda b: bytes(b).decode().split("\x0c")).collect()
    assert sorted((r["page"], r["text"]) for r in got) == [(1, "one"), (3, "three")]
    chunks = spark.createDataFrame([("a\n\"b\"", 5), ("c", 1)], "text string, chunk_size int")
    files.write_chunks(chunks, str(tmp_path / "c"), "csv")
    assert sorted(map(tuple, files.read_chunks(spark, str(tmp_path / "c"), "csv").collect())) == sorted(map(tuple, chunks.collect()))
    emb = spark.createDataFrame([("x", [1.0, 0.5])], "text string, embedding array<float>")
    files.write_embeddings(emb, str(tmp_path / "e"))
    assert files.read_embeddings(spark, str(tmp_path / "e")).first()["embedding"] == [1.0, 0.5]
    files.export_results(spark.createDataFrame([(1, ["a", "b"])], "id int, st array<string>"), str(tmp_path / "r"))
    assert files.read_requests(spark, str(tmp_path / "r"), "id int, st string").first()["st"] == '["a","b"]'


def test_ledger_append_rejects_unknown_types(spark, tmp_path):
    rows = spark.createDataFrame([(1, "sales"), (2, "gift"), (3, None)], "id int, txn_type string")
    bad = files.append_transactions(rows, str(tmp_path / "l"))
    assert sorted(r["id"] for r in bad.collect()) == [2, 3]
    files.append_transactions(rows, str(tmp_path / "l"))
    assert spark.read.parquet(str(tmp_path / "l")).count() == 2


def test_collections(spark, tmp_path):
    col = collections.Collections(spark, str(tmp_path / "root"))
    col.create("a", "id long, text string")
    with pytest.raises(ValueError):
        col.create("a", "id long, text string")
    docs = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z")], "id long, text string")
    assert col.add("a", docs).count() == 2 and col.add("a", docs).count() == 2
    assert col.create("a", "id long, text string", force=True).count() == 0
    assert col.get_or_create("b", "id long, text string").count() == 0 and col.names() == ["a", "b"]
    assert col.delete("b") and not col.exists("b")
    with pytest.raises(KeyError):
        col.get("b")


@pytest.mark.parametrize("fraction", [0.0, 0.4, 1.0])
def test_exact_sample(spark, fraction):
    df = spark.range(997)
    got = sampling.sample_exact(df, "id", fraction, 7)
    ids = {r["id"] for r in got.collect()}
    assert len(ids) == int(997 * fraction) and ids == {r["id"] for r in sampling.sample_exact(df, "id", fraction, 7).collect()}


def test_model_errors_stay_with_their_row(spark):
    def model(prompts):
        if any("bad" in p for p in prompts):
            raise RuntimeError("no")
        return [p.upper() for p in prompts]

    df = spark.createDataFrame([(1, "a"), (2, "bad"), (3, None), (4, "d")], "id int, p string").coalesce(1)
    got = {r["id"]: (r["answer"], r["error"]) for r in models.complete(df, "p", model).collect()}
    assert got == {1: ("A", None), 2: (None, "RuntimeError: no"), 3: (None, None), 4: ("D", None)}


def test_refine_sends_only_failures_on(spark):
    df = spark.createDataFrame([(i, f"task {i}") for i in range(6)], "id int, p string")

    def judge(texts):
        return [("0.9|fine" if int(t.split()[1].split("\n")[0]) % 2 == 0 or t.count("Improve") else "0.1|redo") for t in texts]

    out = models.refine(df, "p", lambda ps: [f"did {p.count('Improve it')}" for p in ps], judge, 0.8, 3)
    got = {r["id"]: (r["passed"], r["iterations"], r["response"]) for r in out.collect()}
    assert all(got[i] == (True, 1, "did 0") for i in (0, 2, 4)) and all(got[i] == (False, 3, "did 1") for i in (1, 3, 5))


def test_parse_structured(spark):
    rows = [("```json\n{\"a\": 1, \"b\": \"x\"}\n```",), ("{'a': 2, 'b': 'y'}",), ("sorry",), (None,)]
    df = spark.createDataFrame(rows, "t string")
    got = models.parse_structured(df, "t", "a int, b string").collect()
    assert [r["parsed"] and tuple(r["parsed"]) for r in got] == [(1, "x"), (2, "y"), None, None]
    assert [r["parsed_error"] for r in got] == [None, None, "sorry", ""]
    fb = models.parse_structured(df, "t", "a int, b string", fallback=F.struct(F.lit(0).alias("a"), F.lit("-").alias("b")))
    assert [tuple(r["parsed"]) for r in fb.collect()][2] == (0, "-")


def test_steps_that_need_other_answers(spark):
    routes = spark.createDataFrame([("cost", [1.0, 0.0]), ("build", [0.0, 1.0])], "route string, vec array<float>")
    plans = spark.createDataFrame([(1, "build it\n\nprice it\nbuild more")], "id long, plan string")
    embed = F.when(F.contains("step", F.lit("price")), F.array(F.lit(1.0), F.lit(0.1))).otherwise(F.array(F.lit(0.1), F.lit(1.0)))
    out = models.run_steps(plans, "id", "plan", embed, routes, lambda ps: [p.replace("\n", "/") for p in ps], {"cost": ["build"]}).first()
    assert [tuple(s) for s in out["steps"]] == [
        ("build", "build: build it"), ("cost", "cost: price it/build: build it/build: build more"), ("build", "build: build more")]


def test_tool_registry(spark):
    tools = models.Tools()

    @tools.add
    def area(w: float, h: float = 2.0, tags: list[str] | None = None) -> float:
        """Area."""
        return w * h

    assert tools.describe() == [{"name": "area", "description": "Area.", "arguments": {"w": "double", "h": "double", "tags": "array<string>"}, "required": ["w"]}]
    msgs = spark.createDataFrame([(1, [("area", '{"w": 3}'), ("area", "{}"), ("area", "{"), ("none", "{}"), ("area", '{"w": "x", "h": "y"}')])],
                                 "id int, tool_calls array<struct<name:string,arguments:string>>")
    got = [(r["result"], r["error"]) for r in tools.dispatch(msgs).orderBy("call_no").collect()]
    assert got[:4] == [("6.0", None), (None, "arguments do not fit the tool"), (None, "arguments are not valid JSON"), (None, "unknown tool none")]
    assert got[4][0] is None and got[4][1].startswith("TypeError")


def test_single_step_scores(spark):
    runs = spark.createDataFrame([(i, ["search"]) for i in range(4)], "run_id int, expected_tools array<string>")
    calls = [(0, "search", "{}"), (1, "search", "{"), (2, "other", "{}")]
    msgs = spark.createDataFrame([(r, 1, "assistant", [(t, a)]) for r, t, a in calls], "run_id int, seq int, role string, tool_calls array<struct<name:string,arguments:string>>")
    got = {r["run_id"]: round(r["score"], 6) for r in evals.single_step_scores(runs, msgs).collect()}
    assert got == {0: 1.0, 1: 0.666667, 2: 0.333333, 3: 0.0}


def test_memory_time_range_is_open(spark):
    day = 86400
    rows = [(1, "u", "default", -7 * day, [1.0, 0.0]), (2, "u", "default", -10 * day, [0.0, 1.0]), (3, "u", "default", -14 * day, [1.0, 1.0]), (4, "v", "default", -10 * day, [1.0, 0.0])]
    mem = spark.createDataFrame(rows, "id long, owner string, namespace string, timestamp long, vec array<float>")
    q = spark.createDataFrame([(0, "u", [1.0, 0.0])], "query_id long, owner string, vec array<float>")
    assert [r["id"] for r in memory.search_memory(mem, q, after=-14 * day, before=-7 * day).collect()] == [2]
    assert [r["id"] for r in memory.search_memory(mem, q).orderBy("rank").collect()] == [1, 3, 2]


def test_default_session_stays_and_routed_collections(spark):
    log = spark.createDataFrame([("default", 1), ("a", 1), ("a", 2), ("b", 1)], "s string, seq long")
    left = memory.remove_sessions(log, log.select("s").filter("s != 'b'"), "s")
    assert sorted({r["s"] for r in left.collect()}) == ["b", "default"]
    popped, rest = memory.pop_last(log, "s", "seq")
    assert popped.count() == 3 and [tuple(r) for r in rest.collect()] == [("a", 1)]
    games = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.9, 0.1])], "id long, vec array<float>")
    films = spark.createDataFrame([(7, [0.0, 1.0])], "id long, vec array<float>")
    routes = spark.createDataFrame([("films", [0.0, 1.0]), ("games", [1.0, 0.0])], "route string, vec array<float>")
    q = spark.createDataFrame([(0, [0.8, 0.2]), (1, [0.1, 0.9])], "query_id long, vec array<float>")
    got = rag.search_routed({"games": games, "films": films}, routes, q, 1).collect()
    assert {(r["query_id"], r["source"], r["id"]) for r in got} == {(0, "games", 2), (1, "films", 7)}


def test_streams_equal_batch(spark, tmp_path):
    rows = [(i, f"i{i % 5}", "sales" if i % 3 == 0 else "stock_orders", i % 7, Decimal(i), None) for i in range(60)]
    df = spark.createDataFrame(rows, TXN)
    df.repartition(4).write.parquet(str(tmp_path / "in"))
    src = lambda: spark.readStream.schema(TXN).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    jobs.run_available(jobs.stock_stream(src()), str(tmp_path / "stock"), str(tmp_path / "c1"), "update")
    now = jobs.current(spark.read.parquet(str(tmp_path / "stock")), ["item"], "version")
    assert {(r["item"], r["stock"]) for r in now.collect()} == {(r["item"], r["stock"]) for r in ledger.stock_levels(df).collect()}
    turns = src().select((F.col("txn_id") % 3).alias("session"), F.col("txn_id").alias("seq"), F.col("item").alias("line"))
    jobs.run_available(jobs.session_stream(turns, n=4), str(tmp_path / "s"), str(tmp_path / "c2"), "update")
    last = {r["session"]: r for r in jobs.current(spark.read.parquet(str(tmp_path / "s")), ["session"], "n_turns").collect()}
    for s in range(3):
        ids = [i for i in range(60) if i % 3 == s]
        assert (last[s]["n_turns"], last[s]["last_seq"], last[s]["context"]) == (20, ids[-1], "\n".join(f"i{i % 5}" for i in ids[-4:]))


def test_repeated_batch_writes_the_same(spark, tmp_path):
    import datetime as dt

    d = dt.date(2025, 4, 1)
    opening = spark.createDataFrame([("A", "stock_orders", 100, Decimal("10.00"), d)], "item string, txn_type string, units long, price decimal(18,2), txn_date date")
    lines = spark.createDataFrame([(1, 1, "A", 60), (2, 1, "A", 60)], "request_id long, line_no long, item string, quantity long")
    catalog = spark.createDataFrame([("A", Decimal("0.10"))], "item string, unit_price decimal(18,2)")
    inv = catalog.withColumn("min_stock_level", F.lit(10).cast("long"))
    reqs = spark.createDataFrame([(1, d, "ORDER", None), (2, d, "ORDER", None)], "request_id long, request_date date, intent string, requested_by date")
    path = str(tmp_path / "out")
    schema = "request_id long, line_no long, item string, step int, txn_type string, units long, price decimal(18,2), txn_date date"
    work = jobs.request_handler(lines, catalog, inv, jobs.ledger_before(opening, path, schema))
    write = jobs.write_by_batch(path, work)
    write(reqs.filter("request_id = 1"), 0)
    for _ in range(2):  # the second run of batch 1 sees the ledger as before batch 1
        write(reqs.filter("request_id = 2"), 1)
    got = sorted((r["request_id"], r["txn_type"], r["units"]) for r in spark.read.parquet(path).collect())
    assert got == [(1, "sales", 60), (2, "sales", 60), (2, "stock_orders", 20), (2, "stock_orders", 60)]
    assert fulfil.overall_status(spark.createDataFrame([], "request_id long, status string, total_price decimal(18,2)"), reqs).first()["overall_status"] == "INVALID"
