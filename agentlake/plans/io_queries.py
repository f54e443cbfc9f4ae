"""Source, sink, allocation and streaming queries. Files go to fresh folders under the shared folder."""

from __future__ import annotations


from pyspark.sql import functions as F

from agentlake.core import table
from agentlake.operators import allocation
from agentlake.operators.scans import paged_lists
from agentlake.plans import derive, fulfil_queries
from agentlake.plans.derive import LEDGER_SQL
from agentlake.streaming.balances import Balances
from agentlake.plans.registry import ORACLE, query
from agentlake.sources import files
from agentlake.sources.collections import Collections
from agentlake.streaming import jobs


@query("s1_s2_read_requests_csv", """SELECT doc_id, lang, text, n_chars FROM documents""")
def read_requests_csv(spark, sf):
    path = files.scratch_path(spark, "requests")
    rows = table(spark, sf, "documents").select("doc_id", "lang", "text", "n_chars")
    files.write_csv(rows, path)
    return files.read_requests(spark, path, rows.schema)


@query(
    "s3_json_documents",
    """SELECT CAST(n_nationkey AS VARCHAR) AS id, '[' || n_name || '] ' || count(c_custkey) || ' customers, best ' || max(c_custkey) AS content
    FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY n_nationkey, n_name""",
)
def json_documents(spark, sf):
    path = files.scratch_path(spark, "cards")
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    cards = table(spark, sf, "customer").join(nation, "c_nationkey").groupBy(F.col("c_nationkey").alias("stem"), "n_name").agg(
        F.count("*").alias("n"), F.max("c_custkey").alias("best")
    )
    cards.repartition("stem").write.partitionBy("stem").json(path)
    docs = files.read_json_documents(spark, path, "n_name string, n long, best long", "[{n_name}] {n} customers, best {best}", r"stem=(\d+)/")
    return docs.select("id", "content")


@query(
    "s4_embeddings_jsonl",
    """SELECT vec_id, CAST(len(embedding) AS BIGINT) AS dim, round(CAST(embedding[1] AS DOUBLE), 6) AS first, round(CAST(embedding[64] AS DOUBLE), 6) AS last FROM embeddings""",
)
def embeddings_jsonl(spark, sf):
    path = files.scratch_path(spark, "embeddings")
    files.write_embeddings(table(spark, sf, "embeddings").select("vec_id", "embedding"), path)
    back = files.read_embeddings(spark, path, "vec_id long, embedding array<float>")
    at = lambda i: F.round(F.col("embedding")[i].cast("double"), 6)
    return back.select("vec_id", F.size("embedding").cast("long").alias("dim"), at(0).alias("first"), at(63).alias("last"))


@query(
    "s5_page_documents",
    r"""WITH p AS (SELECT page_id, regexp_extract_all(html, '(?s)<p>(.*?)</p>', 1) AS ps FROM pages),
    x AS (SELECT page_id, unnest(ps) AS t, generate_subscripts(ps, 1) AS page FROM p)
    SELECT page_id, page, regexp_replace(t, '<[^>]*>', '', 'g') AS text FROM x WHERE trim(regexp_replace(regexp_replace(t, '<[^>]*>', '', 'g'), '\s+', '', 'g')) <> ''""",
)
def page_documents(spark, sf):
    return files.split_pages(table(spark, sf, "pages"), "page_id", "html", r"(?s)<p>(.*?)</p>", r"<[^>]*>")


@query(
    "s7_export_results",
    f"""WITH {fulfil_queries.QUOTED_SQL}, n AS (SELECT request_id, status, row_number() OVER (PARTITION BY request_id ORDER BY line_no, item, ship_date) AS rn FROM quoted)
    SELECT request_id, (rn - 1) // 100 AS page, '[' || string_agg('"' || status || '"', ',' ORDER BY rn) || ']' AS line_statuses FROM n GROUP BY 1, 2""",
)
def export_results(spark, sf):
    quoted = fulfil_queries.quoted(spark, sf).select("request_id", "line_no", "item", "ship_date", "status")
    lists = paged_lists(quoted, ["request_id"], ["line_no", "item", "ship_date"], F.col("line_no"), F.col("status"), 100, "line_statuses")
    path = files.scratch_path(spark, "results")
    files.export_results(lists.select("request_id", "page", "line_statuses"), path)
    return files.read_requests(spark, path, "request_id long, page long, line_statuses string")


@query(
    "s8_collection_lifecycle",
    """SELECT 'texts' AS collection, (SELECT count(*) FROM documents) + (SELECT count(*) FROM pages WHERE page_id NOT IN (SELECT doc_id FROM documents)) AS n
    UNION ALL SELECT 'pages', count(*) FROM pages""",
)
def collection_lifecycle(spark, sf):
    col = Collections(spark, files.scratch_path(spark, "collections"))
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text")
    pages = table(spark, sf, "pages").select(F.col("page_id").alias("id"), F.col("html").alias("text"))
    col.create("texts", docs.schema)
    col.create("pages", docs.schema)
    col.create("old", docs.schema)
    col.add("texts", docs)
    col.add("texts", pages)
    col.add("pages", pages)
    col.delete("old")
    out = None
    for name in col.names():
        part = col.get(name).agg(F.count("*").alias("n")).select(F.lit(name).alias("collection"), "n")
        out = part if out is None else out.unionByName(part)
    return out


ALLOCATION_SQL = """o AS (SELECT o_custkey % 50 AS site, o_orderkey AS seq, 1 + o_orderkey % 40 AS q FROM orders),
    g AS (SELECT site, list({'rem': CAST(0 AS BIGINT), 'q': q, 'id': seq, 'ids': CAST([] AS BIGINT[])} ORDER BY seq) AS l FROM o GROUP BY 1),
    r AS (SELECT site, list_reduce(l, lambda a, x: {'rem': CASE WHEN x.q <= a.rem THEN a.rem - x.q ELSE a.rem END, 'q': CAST(0 AS BIGINT), 'id': CAST(0 AS BIGINT),
      'ids': CASE WHEN x.q <= a.rem THEN list_append(a.ids, x.id) ELSE a.ids END},
      {'rem': 2000 + site, 'q': CAST(0 AS BIGINT), 'id': CAST(0 AS BIGINT), 'ids': CAST([] AS BIGINT[])}).ids AS ids FROM g)"""


def _site_orders(spark, sf):
    key = F.col("o_orderkey")
    return table(spark, sf, "orders").select((F.col("o_custkey") % 50).alias("site"), key.alias("seq"), F.lit(0).alias("item"), (key % 40 + 1).alias("quantity"))


@query(
    "x3_allocate",
    f"""WITH {ALLOCATION_SQL} SELECT o.site, o.seq, list_contains(r.ids, o.seq) AS accepted FROM o JOIN r USING (site)""",
)
def allocate(spark, sf):
    orders = _site_orders(spark, sf)
    stock = orders.select("site").distinct().select("site", F.lit(0).alias("item"), (F.col("site") + 2000).alias("amount"))
    return allocation.allocate(orders, stock)


ALL_ITEMS_SQL = """o AS (SELECT o_custkey % 50 AS site, o_orderkey AS seq, o_orderkey % 3 AS a, 1 + o_orderkey % 40 AS qa, 3 + o_orderkey % 2 AS b, 1 + o_orderkey % 7 AS qb FROM orders),
    l AS (SELECT site, list({'a': a, 'qa': qa, 'b': b, 'qb': qb, 'id': seq, 'r': CAST([] AS BIGINT[]), 'ids': CAST([] AS BIGINT[])} ORDER BY seq) AS l,
      list(DISTINCT a) AS ha, list(DISTINCT b) AS hb FROM o GROUP BY 1),
    g AS (SELECT site, l, [CASE WHEN list_contains(list_concat(ha, hb), i) THEN 600 ELSE 0 END FOR i IN [0, 1, 2, 3, 4]]::BIGINT[] AS start FROM l),
    r AS (SELECT site, list_reduce(l, lambda s, x: {'a': CAST(0 AS BIGINT), 'qa': CAST(0 AS BIGINT), 'b': CAST(0 AS BIGINT), 'qb': CAST(0 AS BIGINT), 'id': CAST(0 AS BIGINT),
        'r': CASE WHEN s.r[x.a + 1] >= x.qa AND s.r[x.b + 1] >= x.qb
             THEN [s.r[1] - CASE WHEN x.a = 0 THEN x.qa ELSE 0 END, s.r[2] - CASE WHEN x.a = 1 THEN x.qa ELSE 0 END, s.r[3] - CASE WHEN x.a = 2 THEN x.qa ELSE 0 END,
                   s.r[4] - CASE WHEN x.b = 3 THEN x.qb ELSE 0 END, s.r[5] - CASE WHEN x.b = 4 THEN x.qb ELSE 0 END] ELSE s.r END,
        'ids': CASE WHEN s.r[x.a + 1] >= x.qa AND s.r[x.b + 1] >= x.qb THEN list_append(s.ids, x.id) ELSE s.ids END},
      {'a': CAST(0 AS BIGINT), 'qa': CAST(0 AS BIGINT), 'b': CAST(0 AS BIGINT), 'qb': CAST(0 AS BIGINT), 'id': CAST(0 AS BIGINT), 'r': start, 'ids': CAST([] AS BIGINT[])}).ids AS ids FROM g)"""


@query("x3_allocate_all_ingredients", f"WITH {ALL_ITEMS_SQL} SELECT o.site, o.seq, list_contains(r.ids, o.seq) AS accepted FROM o JOIN r USING (site)")
def allocate_all(spark, sf):
    key = F.col("o_orderkey")
    lines = table(spark, sf, "orders").select(
        (F.col("o_custkey") % 50).alias("site"), key.alias("seq"),
        F.explode(F.array(
            F.struct((key % 3).alias("item"), (key % 40 + 1).alias("quantity")), F.struct((key % 2 + 3).alias("item"), (key % 7 + 1).alias("quantity"))
        )).alias("l"),
    ).select("site", "seq", "l.item", "l.quantity")
    stock = lines.select("site", "item").distinct().withColumn("amount", F.lit(600).cast("long"))
    return allocation.allocate(lines, stock)


CONTESTED_SQL = ALLOCATION_SQL.replace("o_custkey % 50 AS site", "o_custkey % 2 AS site").replace("1 + o_orderkey % 40 AS q", "1 + (o_orderkey * 7919) % 997 AS q").replace("2000 + site", "400000 + site")


@query("x3_allocate_contested", f"WITH {CONTESTED_SQL} SELECT o.site, o.seq, list_contains(r.ids, o.seq) AS accepted FROM o JOIN r USING (site)")
def allocate_contested(spark, sf):
    """Two sites take all orders and refuse most: both are settled in rounds."""
    key = F.col("o_orderkey")
    orders = table(spark, sf, "orders").select(
        (F.col("o_custkey") % 2).alias("site"), key.alias("seq"), F.lit(0).alias("item"), ((key * 7919) % 997 + 1).alias("quantity")
    )
    stock = orders.select("site").distinct().select("site", F.lit(0).alias("item"), (F.col("site") + 400_000).alias("amount"))
    return allocation.allocate(orders, stock, hot_lines=2000)


def _stream(spark, sf, name):
    return spark.readStream.schema(table(spark, sf, name).schema).parquet(f"{sf}/{name}.parq*")


def _ledger_rows(lines):
    return lines.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("txn_id"), F.col("l_partkey").alias("item"),
        F.when(F.col("l_returnflag") == "R", "sales").otherwise("stock_orders").alias("txn_type"),
        F.col("l_quantity").cast("long").alias("units"), F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
        F.col("l_shipdate").cast("date").alias("txn_date"),
    )


@query(
    "t1_streaming_stock",
    f"""WITH {LEDGER_SQL} SELECT item, CAST(sum(CASE WHEN txn_type = 'stock_orders' THEN units ELSE -units END) AS BIGINT) AS stock FROM ledger GROUP BY 1""",
)
def streaming_stock(spark, sf):
    path = files.scratch_path(spark, "stock")
    jobs.run_available(jobs.stock_stream(_ledger_rows(_stream(spark, sf, "lineitem"))), path, f"{path}-state", "update")
    return jobs.current(spark.read.parquet(path), ["item"], "version").select("item", "stock")


@query(
    "t1_streaming_cash",
    f"""WITH {LEDGER_SQL} SELECT CAST(sum(CASE WHEN txn_type = 'sales' THEN price ELSE -price END) AS DOUBLE) AS cash_balance FROM ledger""",
)
def streaming_cash(spark, sf):
    path = files.scratch_path(spark, "cash")
    jobs.run_available(jobs.cash_stream(_ledger_rows(_stream(spark, sf, "lineitem"))), path, f"{path}-state", "update")
    now = jobs.current(spark.read.parquet(path), ["txn_type"], "version")
    return now.agg(F.sum("cash").cast("double").alias("cash_balance"))


@query(
    "t1_streaming_balances",
    f"""WITH {LEDGER_SQL} SELECT item, txn_type, CAST(sum(units) AS BIGINT) AS units, CAST(sum(price) AS DOUBLE) AS price FROM ledger GROUP BY 1, 2""",
)
def streaming_balances(spark, sf):
    """Many small batches, with snapshots in between."""
    source, path = files.scratch_path(spark, "arrivals"), files.scratch_path(spark, "balances")
    rows = _ledger_rows(table(spark, sf, "lineitem"))
    rows.repartition(12, "txn_id").write.parquet(source)
    state = Balances(spark, path, rows.schema, ["item", "txn_type"], ["units", "price"], every=3)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source)
    jobs.run_balances(stream, state, f"{path}-state")
    return state.now().select("item", "txn_type", "units", F.col("price").cast("double").alias("price"))


@query(
    "t1_streaming_dedup",
    """WITH e AS (SELECT event_id, ts, epoch_us(ts) AS us, min(epoch_us(ts)) OVER () AS lo, max(epoch_us(ts)) OVER () AS hi FROM events)
    SELECT event_id, ts, (SELECT count(*) FROM e WHERE us < lo + (hi - lo) // 4 - (hi - lo) // 32) AS late FROM e""",
)
def streaming_dedup(spark, sf):
    """Deliveries in three files: half of the time; the rest up to three quarters and some of the first again; the last quarter
    and, after the watermark that the second file began with, nearly the first quarter again."""
    events = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    at = F.unix_micros("ts")
    lo, hi = events.agg(F.min(at), F.max(at)).first()
    quarter = (hi - lo) // 4
    source, path = files.scratch_path(spark, "deliveries"), files.scratch_path(spark, "distinct")
    first, again = at < lo + 2 * quarter, at >= lo + 2 * quarter - quarter // 4
    for part in (events.filter(first), events.filter(again & (at < lo + 3 * quarter)), events.filter((at >= lo + 3 * quarter) | (at < lo + quarter - (hi - lo) // 32))):
        part.coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(source)
    q = jobs.run_available(jobs.distinct_events(stream, "event_id", "ts", f"{quarter // 1_000_000} seconds"), path, f"{path}-state", "append")
    return spark.read.parquet(path).select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), F.lit(jobs.late_rows(q)).cast("long").alias("late"))


@query(
    "t2_streaming_sessions",
    """WITH r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS rn, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations)
    SELECT conv_id AS session, n AS n_turns, max(turn) AS last_seq, string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS context
    FROM r WHERE rn <= 6 GROUP BY 1, 2""",
)
def streaming_sessions(spark, sf):
    turns = _stream(spark, sf, "conversations").select(F.col("conv_id").alias("session"), F.col("turn").alias("seq"), F.concat_ws(": ", "role", "text").alias("line"))
    path = files.scratch_path(spark, "sessions")
    jobs.run_available(jobs.session_stream(turns), path, f"{path}-state", "update")
    return jobs.current(spark.read.parquet(path), ["session"], "n_turns").select("session", "n_turns", "last_seq", "context")


@query("t3_streaming_requests", ORACLE["x2_ledger_writes"])
def streaming_requests(spark, sf):
    day, pri = F.col("o_orderdate").cast("date"), F.col("o_orderpriority")
    requests = _stream(spark, sf, "orders").select(
        F.col("o_orderkey").alias("request_id"), F.col("o_custkey").alias("customer"), day.alias("request_date"),
        F.when(F.col("o_orderstatus") == "F", "QUOTE").otherwise("ORDER").alias("intent"),
        F.when(pri == "1-URGENT", day).when(pri == "2-HIGH", F.date_add(day, 1)).when(pri == "3-MEDIUM", F.date_add(day, 4))
        .when(pri == "5-LOW", F.date_add(day, 7)).alias("requested_by"),
    )
    path = files.scratch_path(spark, "requests")
    opening = derive.ledger(spark, sf).select("item", "txn_type", "units", "price", "txn_date")
    state = jobs.ledger_state(opening, f"{path}-ledger")
    work = jobs.request_handler(derive.request_lines(spark, sf), derive.catalog(spark, sf), derive.inventory(spark, sf), state.before)
    jobs.run_available(requests, path, f"{path}-state", "append", work, state)
    return spark.read.parquet(path).select(
        "request_id", "line_no", "item", F.col("ship_date").cast("string").alias("ship_date"), F.col("step").cast("long").alias("step"),
        "txn_type", "units", F.col("price").cast("double").alias("price"), F.col("txn_date").cast("string").alias("txn_date"),
    )
