"""Queries for model calls over rows, with a deterministic stand-in model, and for text columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from agentlake.core import spread, table
from agentlake.functions import text as tx
from agentlake.functions import vectors as vec
from agentlake.operators import models as op
from agentlake.plans import derive
from agentlake.plans.derive import MESSAGES_SQL
from agentlake.plans.registry import query


def short(prompts):
    """Stand-in model: the length of the prompt and its last 12 characters."""
    return [f"{len(p)}:{p[-12:]}" for p in prompts]


def picky(prompts):
    """Stand-in model that refuses texts with a question of even length."""
    if any(len(p) % 7 == 0 for p in prompts):
        raise ValueError("refused")
    return short(prompts)


def judge(texts):
    """Stand-in judge: the score grows with every earlier answer in the text."""
    return [f"{min(1.0, 0.25 * (1 + len(t) % 4))}|length {len(t)}" for t in texts]


SHORT = "length({p}) || ':' || right({p}, 12)"
PERSONA = "'You are a clerk.' || chr(10) || 'Use only this knowledge: prices' || chr(10) || text"


@query(
    "m1_complete",
    f"""SELECT conv_id, turn, CASE WHEN length({PERSONA}) % 7 <> 0 THEN {SHORT.format(p='(' + PERSONA + ')')} END AS answer,
    CASE WHEN length({PERSONA}) % 7 = 0 THEN 'ValueError: refused' END AS error FROM conversations""",
)
def complete(spark, sf):
    rows = table(spark, sf, "conversations")
    out = op.complete(rows, op.prompt_of(F.col("text"), "a clerk", "prices"), picky)
    return out.select("conv_id", "turn", "answer", "error")


@query(
    "m2_parse_structured",
    """SELECT event_id, CASE WHEN event_id % 3 = 2 THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k,
    CASE WHEN event_id % 3 = 2 THEN 'no json here' END AS error FROM events""",
)
def parse_structured(spark, sf):
    m = F.col("event_id") % 3
    text = (
        F.when(m == 0, F.concat(F.lit("```json\n"), F.col("props"), F.lit("\n```")))
        .when(m == 1, F.concat(F.lit("Here it is: "), F.translate("props", '"', "'"), F.lit(" as asked")))
        .otherwise("no json here")
    )
    rows = table(spark, sf, "events").select("event_id", text.alias("answer"))
    out = op.parse_structured(rows, "answer", "k long")
    return out.select("event_id", F.col("parsed.k").alias("k"), F.col("parsed_error").alias("error"))


def refine_sql(threshold: float, rounds: int) -> str:
    """The refinement of ``short`` and ``judge`` unrolled: one CTE per round, failing rows go on."""
    parts = ["p1 AS (SELECT conv_id, turn, text, text AS p FROM conversations)"]
    for n in range(1, rounds + 1):
        parts += [
            f"a{n} AS (SELECT *, {SHORT.format(p='p')} AS response FROM p{n})",
            f"b{n} AS (SELECT *, length(text || chr(10) || '---' || chr(10) || response) AS size FROM a{n})",
            f"r{n} AS (SELECT *, 0.25::DOUBLE * (1 + size % 4) AS score, 'length ' || size AS evaluation FROM b{n})",
            f"p{n + 1} AS (SELECT conv_id, turn, text, text || chr(10) || 'Earlier answer: ' || response || chr(10) || 'Improve it: ' || evaluation AS p"
            f" FROM r{n} WHERE score < {threshold})",
        ]
    ends = [
        f"SELECT conv_id, turn, response, evaluation, CAST({n} AS BIGINT) AS iterations, score >= {threshold} AS passed, score FROM r{n}"
        + ("" if n == rounds else f" WHERE score >= {threshold}")
        for n in range(1, rounds + 1)
    ]
    return "WITH " + ", ".join(parts) + " " + " UNION ALL ".join(ends)


@query("m3_evaluate_and_refine", refine_sql(0.75, 4))
def refine(spark, sf):
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    out = op.refine(rows, "text", short, judge, threshold=0.75, max_rounds=4)
    return out.select("conv_id", "turn", "response", "evaluation", "iterations", "passed", "score")


EXPERTS = {"finance": "a banker", "legal": "a lawyer"}


@query(
    "m4_parallel_experts",
    f"""WITH a AS (SELECT doc_id, {SHORT.format(p="('You are a banker.' || chr(10) || text)")} AS f, {SHORT.format(p="('You are a lawyer.' || chr(10) || text)")} AS l FROM documents),
    p AS (SELECT doc_id, 'Summarize:' || chr(10) || 'finance: ' || f || chr(10) || 'legal: ' || l AS p FROM a)
    SELECT doc_id, {SHORT.format(p='p')} AS summary FROM p""",
)
def experts(spark, sf):
    return op.ask_experts(table(spark, sf, "documents"), "doc_id", "text", EXPERTS, short, short).select("doc_id", "summary")


@query(
    "m5_prompt_chain",
    f"""WITH a AS (SELECT doc_id, {SHORT.format(p='text')} AS s1 FROM documents),
    b AS (SELECT doc_id, s1, {SHORT.format(p="('Improve: ' || s1)")} AS s2 FROM a)
    SELECT doc_id, s1 AS draft, s2 AS better, {SHORT.format(p="(s1 || ' / ' || s2)")} AS final FROM b""",
)
def prompt_chain(spark, sf):
    stages = [
        ("draft", lambda: F.col("text"), short),
        ("better", lambda: F.concat(F.lit("Improve: "), F.col("draft")), short),
        ("final", lambda: F.concat_ws(" / ", "draft", "better"), short),
    ]
    return op.chain(table(spark, sf, "documents").select("doc_id", "text"), stages).select("doc_id", "draft", "better", "final")


@query("m6_plan_route_collect")
def plan_route_collect(spark, sf):
    embed = vec.hashing_embedder(64)
    routes = table(spark, sf, "documents").groupBy(F.col("lang").alias("route")).agg(F.min_by("text", "doc_id").alias("text"))
    routes = routes.select("route", vec.embed_column(F.col("text"), embed).alias("vec"))
    plans = spread(table(spark, sf, "documents").select("doc_id", "text"))
    out = op.run_steps(plans, "doc_id", "text", vec.embed_column(F.col("step"), embed), routes, short, {"en": ["de", "fr"]})
    return out.select("doc_id", "n_steps", F.sha2(F.to_json("steps"), 256).alias("steps_hash"))


_LINES = ("'look A' || doc_id", "'look B' || coalesce(source, '')", "'price ' || coalesce(n_chars, 0)", "'compare ' || coalesce(lang, '')", "'report ' || doc_id")


@query(
    "m6_dependent_routes",
    f"""WITH d AS (SELECT doc_id, doc_id % 2 = 0 AS up, {", ".join(f"{line} AS l{i}" for i, line in enumerate(_LINES))} FROM documents),
    a AS (SELECT *, {SHORT.format(p="('look: ' || l0)")} AS a0, {SHORT.format(p="('look: ' || l1)")} AS a1 FROM d),
    b AS (SELECT *, CASE WHEN up THEN a0 || chr(10) || a1 ELSE a1 || chr(10) || a0 END AS looked FROM a),
    c AS (SELECT *, {SHORT.format(p="('price: ' || l2 || chr(10) || looked)")} AS a2 FROM b),
    e AS (SELECT *, {SHORT.format(p="('compare: ' || l3 || chr(10) || a2)")} AS a3 FROM c),
    f AS (SELECT *, CASE WHEN up THEN looked || chr(10) || a3 ELSE a3 || chr(10) || looked END AS given FROM e),
    g AS (SELECT *, {SHORT.format(p="('report: ' || l4 || chr(10) || given)")} AS a4 FROM f)
    SELECT doc_id, CAST(5 AS BIGINT) AS n_steps,
      array_to_string(CASE WHEN up THEN ['look=' || a0, 'look=' || a1, 'price=' || a2, 'compare=' || a3, 'report=' || a4]
                           ELSE ['report=' || a4, 'compare=' || a3, 'price=' || a2, 'look=' || a1, 'look=' || a0] END, ' | ') AS answers FROM g""",
)
def dependent_routes(spark, sf):
    """Plans of five steps over four routes; prices need what was looked up, comparisons the prices, reports both."""
    names = ["look", "price", "compare", "report"]
    lines = [F.expr(x) for x in _LINES]
    plans = table(spark, sf, "documents").select(
        "doc_id", F.when(F.col("doc_id") % 2 == 0, F.concat_ws("\n", *lines)).otherwise(F.concat_ws("\n", *lines[::-1])).alias("plan")
    )
    embed = F.array(*[F.startswith("step", F.lit(n)).cast("double") for n in names])
    routes = spark.createDataFrame([(n, [float(n == m) for m in names]) for n in names], "route string, vec array<double>")
    out = op.run_steps(plans, "doc_id", "plan", embed, routes, short, {"report": ["compare", "look"], "price": ["look"], "compare": ["price"]})
    shown = F.array_join(F.transform("steps", lambda x: F.concat_ws("=", x["route"], x["answer"])), " | ")
    return out.select("doc_id", "n_steps", shown.alias("answers"))


def word_count(text: str, least: int = 0) -> int:
    """Number of words, at least ``least``."""
    return max(len(text.split()), least)


def add(a: int, b: float = 1.0) -> float:
    """Sum of two numbers."""
    return a + b


@query(
    "m8_tool_registry",
    """SELECT doc_id, len(list_filter(string_split_regex(trim(lang || ' ' || source), '\\s+'), lambda x: x <> '')) AS n_words, CAST(n_chars + 0.5 AS DOUBLE) AS plus_half FROM documents""",
)
def tool_registry(spark, sf):
    tools = op.Tools()
    tools.add(word_count)
    tools.add(add, "add_numbers")
    tools.register(spark)
    rows = table(spark, sf, "documents")
    return rows.select(
        "doc_id", F.call_udf("word_count", F.concat_ws(" ", "lang", "source"), F.lit(0)).alias("n_words"),
        F.call_udf("add_numbers", F.col("n_chars"), F.lit(0.5)).alias("plus_half"),
    )


@query(
    "m9_dispatch_tool_calls",
    f"""WITH {MESSAGES_SQL} SELECT run_id, seq, tool, CASE WHEN tool <> 'lookup' AND length(content) % 5 <> 0 THEN CASE tool WHEN 'search' THEN 'found 1' ELSE '2' END END AS result,
    CASE WHEN tool = 'lookup' THEN 'unknown tool lookup' WHEN length(content) % 5 = 0 THEN 'arguments are not valid JSON' END AS error FROM messages WHERE tool IS NOT NULL""",
)
def dispatch(spark, sf):
    tools = op.Tools()

    def search(q: int) -> str:
        return f"found {q}"

    def compute(q: int) -> int:
        return q + 1

    tools.add(search)
    tools.add(compute)
    return tools.dispatch(derive.messages(spark, sf)).select("run_id", "seq", "tool", "result", "error")


@query(
    "e10_feedback_verdict",
    """SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN false WHEN doc_id % 4 = 1 THEN true WHEN doc_id % 4 = 2 THEN false END AS incorporated FROM documents""",
)
def feedback_verdict(spark, sf):
    m = F.col("doc_id") % 4
    answer = (
        F.when(m == 0, "Result: NOT_FULLY_INCORPORATED, see notes").when(m == 1, "FULLY_INCORPORATED").when(m == 2, "not_incorporated").otherwise("unclear")
    )
    rows = op.complete(table(spark, sf, "documents").select("doc_id", answer.alias("a")), "a", lambda p: [x.strip() for x in p])
    yes, no = ["FULLY_INCORPORATED"], ["NOT_FULLY_INCORPORATED", "NOT_INCORPORATED", "PARTIALLY_INCORPORATED"]
    return rows.select("doc_id", tx.verdict(F.col("answer"), yes, no).alias("incorporated"))


@query(
    "e11_usefulness_report",
    """SELECT doc_id, length(text) % 2 = 0 AS useful, 'length ' || length(text) AS description FROM documents""",
)
def usefulness_report(spark, sf):
    def report(prompts):
        sizes = [len(p.split("\n", 1)[1]) for p in prompts]
        return [f'```json\n{{"useful": {"true" if n % 2 == 0 else "false"}, "description": "length {n}"}}\n```' for n in sizes]

    rows = op.complete(table(spark, sf, "documents").select("doc_id", "text"), F.concat(F.lit("Judge:\n"), F.col("text")), report)
    out = op.parse_structured(rows, "answer", "useful boolean, description string")
    return out.select("doc_id", "parsed.useful", "parsed.description")


@query(
    "f11_collapse_spaces",
    r"""SELECT doc_id, regexp_replace(regexp_replace(text, '[ \t]+', ' ', 'g'), '^\s+|\s+$', '', 'g') AS clean FROM documents""",
)
def collapse_spaces(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.collapse_spaces(F.col("text")).alias("clean"))


@query("f12_truncate", """SELECT doc_id, CASE WHEN length(text) > 300 THEN substr(text, 1, 300) || '...' ELSE text END AS preview FROM documents""")
def truncate(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.truncate(F.col("text"), 300).alias("preview"))


@query("f13_outer_object", """SELECT event_id, props AS body FROM events""")
def outer_object(spark, sf):
    text = F.concat(F.lit("Sure!\n```json\n"), F.col("props"), F.lit("\n```\nDone."))
    return table(spark, sf, "events").select("event_id", tx.outer_object(text).alias("body"))


@query(
    "f14_tags_and_tasks",
    """SELECT event_id, event_type AS kind, event_type || '|' || props || ';' || CAST(user_id AS VARCHAR) || '|' || event_id AS tasks FROM events""",
)
def tags_and_tasks(spark, sf):
    task = lambda k, d: F.concat(F.lit("<task>\n<type> "), k, F.lit(" </type>\n<description> "), d, F.lit(" </description>\n</task>"))
    text = F.concat(
        F.lit("<analysis>"), F.col("event_type"), F.lit("</analysis>\n<tasks>\n"), task(F.col("event_type"), F.col("props")), F.lit("\n"),
        task(F.col("user_id").cast("string"), F.col("event_id").cast("string")), F.lit("<task><type>none</type></task></tasks>"),
    )
    shown = F.array_join(F.transform(tx.parse_tasks(text), lambda t: F.concat(t["type"], F.lit("|"), t["description"])), ";")
    return table(spark, sf, "events").select("event_id", tx.extract_tag(text, "analysis").alias("kind"), shown.alias("tasks"))


@query(
    "f15_lines_of_text",
    """SELECT doc_id, count(*) AS n_lines, CAST(sum(length(l)) AS BIGINT) AS n_chars FROM (SELECT doc_id, trim(unnest(string_split(text, chr(10))), ' ') AS l FROM documents)
    WHERE l <> '' GROUP BY 1""",
)
def lines_of_text(spark, sf):
    lines = tx.lines_of(F.col("text"))
    rows = table(spark, sf, "documents").select("doc_id", F.size(lines).cast("long").alias("n_lines"),
                                               F.aggregate(lines, F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("n_chars"))
    return rows.filter("n_lines > 0")


@query("f16_templates", """SELECT p_partkey AS item, '[' || p_brand || '] ' || p_name || ' (' || p_size || ') - ' || p_type AS card FROM part""")
def templates(spark, sf):
    cols = {"brand": F.col("p_brand"), "name": F.col("p_name"), "size": F.col("p_size"), "type": F.col("p_type")}
    return table(spark, sf, "part").select(F.col("p_partkey").alias("item"), tx.template("[{brand}] {name} ({size}) - {type}", cols).alias("card"))


@query(
    "f17_verdicts",
    """SELECT event_id, CASE event_type WHEN 'click' THEN true WHEN 'view' THEN false END AS compatible FROM events""",
)
def verdicts(spark, sf):
    t = F.col("event_type")
    answer = F.when(t == "click", "Final: IS_COMPATIBLE.").when(t == "view", "IS_INCOMPATIBLE").otherwise("MAYBE_IS_COMPATIBLE_LATER")
    return table(spark, sf, "events").select("event_id", tx.verdict(answer, ["IS_COMPATIBLE"], ["IS_INCOMPATIBLE"]).alias("compatible"))


@query("f20_valid_json", """SELECT conv_id, turn, length(text) % 5 <> 0 AS valid FROM conversations""")
def valid_json(spark, sf):
    args = F.when(F.length("text") % 5 == 0, '{"q": ').otherwise('{"q": [1, {"a": null}]}')
    return table(spark, sf, "conversations").select("conv_id", "turn", tx.valid_json(args).alias("valid"))


def chunks_sql(size: int, overlap: int, min_cut: int = 50) -> str:
    """Recursive CTE ``chunks`` (doc_id, chunk_id, text, chunk_size): one step per chunk of every document."""
    piece = f"substr(t.text, {{s}}, {size})"
    tail = f"length(string_split({piece}, chr(10))[-1])"
    cut = f"length({piece}) - {tail}"
    width = (
        f"CASE WHEN t.total <= {size} THEN t.total WHEN contains({piece}, chr(10)) AND {cut} >= {min_cut} THEN {cut} ELSE length({piece}) END"
    )
    start = f"CASE WHEN c.pos + c.width - {overlap} > c.pos THEN c.pos + c.width - {overlap} ELSE c.pos + c.width END"
    return f"""t AS (SELECT doc_id, text, length(text) AS total FROM
      (SELECT doc_id, regexp_replace(regexp_replace(text, '[ \\t]+', ' ', 'g'), '^\\s+|\\s+$', '', 'g') AS text FROM documents)),
    c AS (SELECT doc_id, CAST(0 AS BIGINT) AS chunk_id, CAST(1 AS BIGINT) AS pos, CAST({width.format(s='1')} AS BIGINT) AS width FROM t
      UNION ALL
      SELECT n.doc_id, n.chunk_id, n.pos, CAST({width.format(s='n.pos')} AS BIGINT)
      FROM (SELECT c.doc_id, c.chunk_id + 1 AS chunk_id, {start} AS pos FROM c JOIN t USING (doc_id) WHERE c.pos + c.width <= t.total) n JOIN t USING (doc_id)),
    chunks AS (SELECT doc_id, chunk_id, substr(text, pos, width) AS text, width AS chunk_size FROM c JOIN t USING (doc_id))"""


@query("v1_chunk_documents", f"WITH RECURSIVE {chunks_sql(500, 200)} SELECT * FROM chunks")
def chunk_documents(spark, sf):
    return tx.chunk_text(spread(table(spark, sf, "documents").select("doc_id", "text")), "doc_id", "text", size=500, overlap=200)


_INDEXED = f"""WITH RECURSIVE {chunks_sql(1200, 100)}, s AS (SELECT doc_id, chunk_id, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS text FROM chunks),
    n AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY chunk_id) - 1 AS chunk_id, text FROM s WHERE text <> '')"""


def _index(docs, max_chunks=None):
    chunks = tx.chunk_text(docs, "doc_id", "text", size=1200, overlap=100, max_chunks=max_chunks, strip=True)
    index = chunks.withColumn("vec", vec.embed_column(F.col("text"), vec.hashing_embedder(16)))
    return index.select("doc_id", "chunk_id", "text", "chunk_size", F.size("vec").cast("long").alias("dim"))


@query("v2_index", f"{_INDEXED} SELECT doc_id, chunk_id, text, length(text) AS chunk_size, CAST(16 AS BIGINT) AS dim FROM n")
def full_index(spark, sf):
    """The index over all chunks of every document."""
    return _index(spread(table(spark, sf, "documents").select("doc_id", "text")))


@query(
    "v2_bounded_index_counts",
    f"""{_INDEXED} SELECT doc_id, count(*) AS n_seen, greatest(count(*) - 80, 0) AS n_dropped FROM n GROUP BY doc_id""",
)
def bounded_index_counts(spark, sf):
    """Chunks of every document, and how many of them ``v2_bounded_index`` leaves out."""
    docs = spread(table(spark, sf, "documents").select("doc_id", "text"))
    return tx.chunk_counts(docs, "doc_id", "text", size=1200, overlap=100, max_chunks=80, strip=True)


@query(
    "v2_bounded_index",
    f"""WITH RECURSIVE {chunks_sql(1200, 100)}, s AS (SELECT doc_id, chunk_id, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS text FROM chunks),
    n AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY chunk_id) - 1 AS chunk_id, text FROM s WHERE text <> '')
    SELECT doc_id, chunk_id, text, length(text) AS chunk_size, CAST(16 AS BIGINT) AS dim FROM n WHERE chunk_id < 80""",
)
def bounded_index(spark, sf):
    """The index with the bound of its source; ``v2_index`` is the whole one, ``v2_bounded_index_counts`` says what is left out."""
    return _index(spread(table(spark, sf, "documents").select("doc_id", "text")), max_chunks=80)
