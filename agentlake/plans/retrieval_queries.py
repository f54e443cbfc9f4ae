"""Vector, memory, session and retrieval queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from agentlake.core import table
from agentlake.functions import vectors as vec
from agentlake.operators import memory as mem
from agentlake.operators import neighbours as nn
from agentlake.operators import predicates as pred
from agentlake.operators import rag
from agentlake.plans import derive
from agentlake.plans.derive import COSINE_SQL, FIRST_OF_LABEL_SQL, PURCHASES_SQL
from agentlake.plans.registry import query

COS = COSINE_SQL.format(a="c.embedding", b="a.vec")


def ranked_sql(where: str, k: int) -> str:
    return f"""{FIRST_OF_LABEL_SQL},
    s AS (SELECT query_id, vec_id AS id, round({COS}, 9) AS score FROM embeddings c, asked a WHERE {where}),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM s),
    top AS (SELECT query_id, rank, id, score FROM r WHERE rank <= {k})"""


@query("v4_vector_query", f"WITH {ranked_sql('label > 2 AND label < 8', 5)} SELECT CAST(query_id AS BIGINT) AS query_id, rank, id, round(score, 6) AS score FROM top")
def vector_query(spark, sf):
    where = {"$and": [{"label": {"$gt": 2}}, {"label": {"$lt": 8}}]}
    out = nn.vector_query(derive.vectors(spark, sf), derive.first_of_label(spark, sf), 5, where=where)
    return out.select(F.col("query_id").cast("long").alias("query_id"), F.col("rank").cast("long").alias("rank"), "id", F.round("score", 6).alias("score"))


TOP_SQL = f"""WITH s AS (SELECT a.vec_id AS query_id, c.vec_id AS id, round({COSINE_SQL.format(a='c.embedding', b='a.embedding')}, 9) AS score
      FROM embeddings c, embeddings a),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM s)
    SELECT query_id, rank, id FROM r WHERE rank <= 3"""


@query("k4_top_k_per_query", TOP_SQL)
def top_k(spark, sf):
    v = derive.vectors(spark, sf)
    out = nn.nearest(v, v.select(F.col("id").alias("query_id"), "vec"), 3)
    return out.select("query_id", F.col("rank").cast("long").alias("rank"), "id")


@query("k4_top_k_many_queries", TOP_SQL)
def top_k_many(spark, sf):
    """As if there were more queries than can be carried: pivot cells."""
    v = derive.vectors(spark, sf)
    out = nn.nearest(v, v.select(F.col("id").alias("query_id"), "vec"), 3, max_carried=100)
    return out.select("query_id", F.col("rank").cast("long").alias("rank"), "id")


@query(
    "v4_nearest_l2",
    f"""WITH {FIRST_OF_LABEL_SQL}, s AS (SELECT query_id, vec_id AS id,
      round(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])) - 2 * list_dot_product(CAST(embedding AS DOUBLE[]), CAST(vec AS DOUBLE[]))
        + list_dot_product(CAST(vec AS DOUBLE[]), CAST(vec AS DOUBLE[])), 9) AS d FROM embeddings, asked),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY d, id) AS rank FROM s)
    SELECT CAST(query_id AS BIGINT) AS query_id, rank, id, round(d, 6) + 0.0 AS distance FROM r WHERE rank <= 3""",
)
def nearest_l2(spark, sf):
    out = nn.nearest(derive.vectors(spark, sf), derive.first_of_label(spark, sf), 3, "l2")
    return out.select(F.col("query_id").cast("long").alias("query_id"), F.col("rank").cast("long").alias("rank"), "id",
                      (F.round("distance", 6) + F.lit(0.0)).alias("distance"))


@query(
    "f10_cosine",
    f"""WITH {FIRST_OF_LABEL_SQL} SELECT vec_id AS id, round({COS}, 6) AS score FROM embeddings c JOIN asked a ON a.query_id = c.label""",
)
def cosine(spark, sf):
    v = derive.vectors(spark, sf)
    first = derive.first_of_label(spark, sf).select(F.col("query_id").alias("label"), F.col("vec").alias("other"))
    return v.join(first, "label").select("id", F.round(vec.cosine(F.col("vec"), F.col("other")), 6).alias("score"))


@query(
    "v8_route_to_similar",
    f"""WITH {FIRST_OF_LABEL_SQL}, s AS (SELECT vec_id AS id, query_id AS route, round({COS}, 9) AS score FROM embeddings c, asked a),
    r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, route) AS rn FROM s)
    SELECT id, CAST(route AS BIGINT) AS route, round(score, 6) AS score FROM r WHERE rn = 1""",
)
def route(spark, sf):
    routes = derive.first_of_label(spark, sf).select(F.col("query_id").cast("long").alias("route"), "vec")
    return nn.route(derive.vectors(spark, sf), routes).select("id", "route", F.round("score", 6).alias("score"))


@query("v16_approximate_neighbours")
def approximate(spark, sf):
    v = derive.vectors(spark, sf)
    return nn.nearest_approximate(v, v.select(F.col("id").alias("query_id"), "vec"), dim=64, bits=4, k=3)


@query(
    "v3_embed_documents",
    """WITH w AS (SELECT doc_id, CAST('0x' || substr(md5(term), 1, 8) AS BIGINT) % 64 AS bucket
         FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}')) AS term FROM documents)),
    c AS (SELECT doc_id, bucket, count(*) AS n FROM w GROUP BY 1, 2),
    m AS (SELECT doc_id, sqrt(sum(n * n)) AS norm, max(n) AS top, count(*) AS used FROM c GROUP BY 1)
    SELECT d.doc_id, coalesce(used, 0) AS used, round(coalesce(top / norm, 0), 4) AS largest FROM documents d LEFT JOIN m USING (doc_id)""",
)
def embed_documents(spark, sf):
    from agentlake.core import spread

    docs = spread(table(spark, sf, "documents").select("doc_id", "text"))
    e = docs.select("doc_id", vec.embed_column(F.col("text"), vec.hashing_embedder(64)).alias("v"))
    used = F.size(F.filter("v", lambda x: x > 0)).cast("long")
    return e.select("doc_id", used.alias("used"), F.round(F.array_max("v").cast("double"), 4).alias("largest"))


@query(
    "v10_memory_search",
    f"""WITH m AS (SELECT vec_id AS id, label AS owner, embedding FROM embeddings WHERE vec_id % 3 = 1 AND vec_id > 20 AND vec_id < 100000000),
    {FIRST_OF_LABEL_SQL},
    s AS (SELECT query_id, id, round(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))
        - 2 * list_dot_product(CAST(embedding AS DOUBLE[]), CAST(vec AS DOUBLE[])) + list_dot_product(CAST(vec AS DOUBLE[]), CAST(vec AS DOUBLE[])), 9) AS d
      FROM m JOIN asked ON owner = query_id),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY d, id) AS rank FROM s)
    SELECT CAST(query_id AS BIGINT) AS query_id, rank, id, round(d, 6) AS distance FROM r WHERE rank <= 3""",
)
def memory_search(spark, sf):
    asked = derive.first_of_label(spark, sf).withColumn("owner", F.col("query_id"))
    out = mem.search_memory(derive.memory(spark, sf), asked, "travel", after=20, before=100_000_000)
    return out.select(F.col("query_id").cast("long").alias("query_id"), F.col("rank").cast("long").alias("rank"), "id", F.round("distance", 6).alias("distance"))


@query(
    "v11_best_memory",
    f"""WITH {FIRST_OF_LABEL_SQL},
    s AS (SELECT query_id, vec_id AS id, round(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))
        - 2 * list_dot_product(CAST(embedding AS DOUBLE[]), CAST(vec AS DOUBLE[])) + list_dot_product(CAST(vec AS DOUBLE[]), CAST(vec AS DOUBLE[])), 9) AS d
      FROM embeddings JOIN asked ON label = query_id AND vec_id % 3 = 0),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY d, id) AS rn FROM s)
    SELECT CAST(query_id AS BIGINT) AS query_id, 'Q: ' || query_id || chr(10) || 'A: ' || id AS content FROM r WHERE rn = 1""",
)
def best_memory(spark, sf):
    asked = derive.first_of_label(spark, sf).withColumn("owner", F.col("query_id"))
    hit = mem.search_memory(derive.memory(spark, sf), asked, k=1)
    text = mem.question_answer_fragment(F.col("query_id").cast("string"), F.col("id").cast("string"))
    return hit.select(F.col("query_id").cast("long").alias("query_id"), text.alias("content"))


@query(
    "v9_rag_context",
    f"""WITH {ranked_sql('true', 3)}
    SELECT CAST(query_id AS BIGINT) AS query_id, 'Answer from the context.' || chr(10) || chr(10) || 'Context:' || chr(10)
      || c
      || chr(10) || chr(10) || 'Question: ' || query_id || chr(10) || chr(10) || 'Answer:' AS prompt
    FROM (SELECT query_id, string_agg(text, chr(10) || chr(10) ORDER BY rank) AS c FROM top JOIN documents ON doc_id = id GROUP BY 1)""",
)
def rag_context(spark, sf):
    asked = derive.first_of_label(spark, sf)
    hits = nn.nearest(derive.vectors(spark, sf), asked, 3)
    ctx = rag.contexts(hits, table(spark, sf, "documents"), "doc_id", "text")
    questions = asked.select("query_id", F.col("query_id").cast("string").alias("question"))
    return rag.prompts(ctx, questions, "question").select(F.col("query_id").cast("long").alias("query_id"), "prompt")


@query(
    "v15_multi_collection",
    f"""WITH {FIRST_OF_LABEL_SQL}, s AS (SELECT CASE WHEN label < 5 THEN 'low' ELSE 'high' END AS source, query_id, vec_id AS id, round({COS}, 9) AS score
      FROM embeddings c, asked a),
    r AS (SELECT *, row_number() OVER (PARTITION BY source, query_id ORDER BY score DESC, id) AS rank FROM s)
    SELECT source, CAST(query_id AS BIGINT) AS query_id, rank, id FROM r WHERE rank <= 2""",
)
def multi_collection(spark, sf):
    v = derive.vectors(spark, sf)
    parts = {"low": v.filter("label < 5"), "high": v.filter("label >= 5")}
    out = rag.search_collections(parts, derive.first_of_label(spark, sf), 2)
    return out.select("source", F.col("query_id").cast("long").alias("query_id"), F.col("rank").cast("long").alias("rank"), "id")


@query(
    "v15_routed_collections",
    f"""WITH routes AS (SELECT CASE label WHEN 1 THEN 'low' ELSE 'high' END AS route, arg_min(embedding, vec_id) AS vec FROM embeddings WHERE label IN (1, 7) GROUP BY label),
    p AS (SELECT a.vec_id AS query_id, route, round({COSINE_SQL.format(a='a.embedding', b='routes.vec')}, 9) AS score FROM embeddings a, routes),
    sent AS (SELECT query_id, route FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, route) AS rn FROM p) WHERE rn = 1),
    s AS (SELECT sent.query_id, route AS source, c.vec_id AS id, round({COSINE_SQL.format(a='c.embedding', b='a.embedding')}, 9) AS score
      FROM sent JOIN embeddings a ON a.vec_id = query_id JOIN embeddings c ON (CASE WHEN c.label < 5 THEN 'low' WHEN c.label >= 5 THEN 'high' END) = route),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM s)
    SELECT query_id, rank, id, source FROM r WHERE rank <= 3""",
)
def routed_collections(spark, sf):
    v = derive.vectors(spark, sf)
    first = v.filter("label IN (1, 7)").groupBy("label").agg(F.min_by("vec", "id").alias("vec"))
    routes = first.select(F.when(F.col("label") == 1, "low").otherwise("high").alias("route"), "vec")
    parts = {"low": v.filter("label < 5"), "high": v.filter("label >= 5")}
    out = rag.search_routed(parts, routes, v.select(F.col("id").alias("query_id"), "vec"), 3)
    return out.select("query_id", F.col("rank").cast("long").alias("rank"), "id", "source")


@query(
    "m7_context_waterfall",
    """WITH m AS (SELECT doc_id % 97 AS topic, min(doc_id) AS hit FROM documents WHERE n_chars > 3000 GROUP BY 1)
    SELECT doc_id, CASE WHEN quality = 1 THEN 'documents' WHEN hit IS NOT NULL THEN 'memory' ELSE 'external' END AS source,
      CASE WHEN quality = 1 THEN text WHEN hit IS NOT NULL THEN 'memory ' || hit ELSE 'searched ' || doc_id END AS context,
      NOT (coalesce(quality, 0) = 1 OR hit IS NOT NULL) AS store
    FROM documents LEFT JOIN labels USING (doc_id) LEFT JOIN m ON m.topic = doc_id % 97""",
)
def context_waterfall(spark, sf):
    docs = table(spark, sf, "documents").withColumn("topic", F.col("doc_id") % 97)
    hits = docs.filter("n_chars > 3000").groupBy("topic").agg(F.min("doc_id").alias("hit"))
    rows = docs.join(table(spark, sf, "labels").select("doc_id", (F.col("quality") == 1).alias("useful")), "doc_id", "left").join(hits, "topic", "left")
    out = rag.choose_context(
        rows, "useful", F.col("text"), F.concat(F.lit("memory "), F.col("hit").cast("string")),
        F.concat(F.lit("searched "), F.col("doc_id").cast("string")),
    )
    return out.select("doc_id", "source", "context", "store")


@query(
    "p7_p8_p9_get_documents",
    """SELECT doc_id, lang, n_chars FROM documents WHERE (lang = 'en' OR lang = 'de') AND n_chars > 200 AND n_chars < 5000
    AND contains(text, 'the') AND source NOT IN ('src3', 'src4') ORDER BY doc_id LIMIT 100""",
)
def get_documents(spark, sf):
    where = {"$and": [{"$or": [{"lang": "en"}, {"lang": {"$eq": "de"}}]}, {"n_chars": {"$gt": 200, "$lt": 5000}}, {"source": {"$nin": ["src3", "src4"]}}]}
    docs = table(spark, sf, "documents")
    return pred.get_documents(docs, "doc_id", where=where, where_document={"$contains": "the"}, limit=100).select("doc_id", "lang", "n_chars")


@query(
    "p9_get_by_ids",
    """SELECT doc_id, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 0)""",
)
def get_by_ids(spark, sf):
    ids = table(spark, sf, "labels").filter("toxic = 0")
    return pred.get_documents(table(spark, sf, "documents"), "doc_id", ids).select("doc_id", "n_chars")


@query("w3_latest_per_session", """SELECT conv_id, max(turn) AS turn, arg_max(role, turn) AS role, arg_max(text, turn) AS text FROM conversations GROUP BY 1""")
def latest_per_session(spark, sf):
    return mem.latest_per_session(table(spark, sf, "conversations"), "conv_id", "turn")


@query(
    "w4_recent_context",
    """WITH r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS rn FROM conversations)
    SELECT conv_id, count(*) AS n_turns, string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS context FROM r WHERE rn <= 6 GROUP BY 1""",
)
def recent_context(spark, sf):
    line = F.concat_ws(": ", "role", "text")
    return mem.recent_context(table(spark, sf, "conversations"), "conv_id", "turn", line, 6)


@query(
    "u4_remove_sessions",
    """SELECT conv_id, turn, role FROM conversations WHERE conv_id NOT IN (SELECT conv_id FROM conversations WHERE role = 'system')""",
)
def remove_sessions(spark, sf):
    log = table(spark, sf, "conversations")
    gone = log.filter("role = 'system'").select("conv_id")
    return mem.remove_sessions(log, gone, "conv_id").select("conv_id", "turn", "role")


@query("u6_pop_last", """SELECT conv_id, turn, role FROM conversations c WHERE turn < (SELECT max(turn) FROM conversations d WHERE d.conv_id = c.conv_id)""")
def pop_last(spark, sf):
    return mem.pop_last(table(spark, sf, "conversations"), "conv_id", "turn")[1].select("conv_id", "turn", "role")


@query("a11_namespaces", """SELECT DISTINCT CAST(label AS BIGINT) AS owner, CASE vec_id % 3 WHEN 0 THEN 'default' WHEN 1 THEN 'travel' ELSE 'games' END AS namespace FROM embeddings""")
def namespaces(spark, sf):
    return mem.namespaces(derive.memory(spark, sf)).withColumn("owner", F.col("owner").cast("long"))


@query(
    "u5_preference_set",
    f"""WITH {PURCHASES_SQL} SELECT DISTINCT "user", item FROM (SELECT "user", item FROM purchases UNION ALL SELECT c_custkey, c_custkey % 100 FROM customer)""",
)
def preference_set(spark, sf):
    have = derive.purchases(spark, sf).select("user", "item").distinct()
    new = table(spark, sf, "customer").select(F.col("c_custkey").alias("user"), (F.col("c_custkey") % 100).alias("item"))
    return mem.add_if_absent(have, new, ["user", "item"])


@query(
    "s9_add_documents",
    """SELECT doc_id, n_chars FROM documents UNION ALL SELECT page_id, length(html) FROM pages WHERE page_id NOT IN (SELECT doc_id FROM documents)""",
)
def add_documents(spark, sf):
    from agentlake.sources.collections import add_documents as add

    docs = table(spark, sf, "documents").select("doc_id", "n_chars")
    pages = table(spark, sf, "pages").select(F.col("page_id").alias("doc_id"), F.length("html").cast("long").alias("n_chars"))
    return add(docs, pages, "doc_id")
