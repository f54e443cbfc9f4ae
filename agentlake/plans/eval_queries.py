"""Evaluation, plan-check and routing queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from agentlake.core import spread, table
from agentlake.operators import evals as op
from agentlake.operators import predicates as pred
from agentlake.operators import scans, trips
from agentlake.plans import derive
from agentlake.plans.derive import ITEMS_SQL, MESSAGES_SQL, PLANS_SQL, RUNS_SQL, TRAVELERS_SQL, WEATHER_SQL
from agentlake.plans.registry import query

# fixed values: the words of the quality rule used on documents
KEYWORDS = ("the", "and", "des", "die", "error")
URGENT_SQL = "(" + " OR ".join(f"contains(lower(text), '{t}')" for t in pred.URGENT_TERMS) + ")"


@query(
    "a10_routing_quality",
    f"""WITH d AS (SELECT lang, CAST(contains(lower(text), 'the') OR contains(lower(text), 'des') AS INTEGER) AS p, quality AS e,
        {URGENT_SQL} AS u, toxic = 1 OR n_chars > 2000 AS s FROM documents JOIN labels USING (doc_id)),
    g AS (SELECT lang, count(*) AS total, count(*) FILTER (p = e) AS correct, count(*) FILTER (u) AS n_urgent, count(*) FILTER (s) AS n_special FROM d GROUP BY lang)
    SELECT *, round(correct * 100.0::DOUBLE / total, 6) AS accuracy, correct * 100.0::DOUBLE / total >= 80 AND n_special >= 2 AND n_urgent >= 1 AS passed FROM g""",
)
def routing_quality(spark, sf):
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    low = F.lower("text")
    rows = docs.select(
        "lang", (F.contains(low, F.lit("the")) | F.contains(low, F.lit("des"))).cast("int").alias("p"), F.col("quality").alias("e"),
        (pred.urgency(F.col("text")) == "urgent").alias("u"), ((F.col("toxic") == 1) | (F.col("n_chars") > 2000)).alias("s"),
    )
    return op.routing_quality(rows, "p", "e", "u", "s", ["lang"]).withColumn("accuracy", F.round("accuracy", 6))


@query(
    "p13_flag_keywords",
    "SELECT doc_id, array_to_string(list_filter(" + repr(list(KEYWORDS)) + ", lambda k: contains(lower(text), k)), ',') AS flags FROM documents",
)
def flag_keywords(spark, sf):
    return spread(table(spark, sf, "documents").select("doc_id", "text")).select("doc_id", F.array_join(pred.flag_keywords(F.col("text"), KEYWORDS), ",").alias("flags"))


@query("p14_urgency", f"SELECT doc_id, CASE WHEN {URGENT_SQL} THEN 'urgent' ELSE 'normal' END AS label FROM documents")
def urgency(spark, sf):
    return spread(table(spark, sf, "documents").select("doc_id", "text")).select("doc_id", pred.urgency(F.col("text")).alias("label"))


@query(
    "p15_first_match_rules",
    """SELECT c_custkey AS customer, CASE c_mktsegment WHEN 'BUILDING' THEN 'high' WHEN 'MACHINERY' THEN 'high' WHEN 'FURNITURE' THEN 'medium' ELSE 'low' END AS intensity
    FROM customer""",
)
def first_match_rules(spark, sf):
    rules = [(["BUILDING", "MACHINERY"], "high"), (["FURNITURE", "MACHINERY"], "medium")]
    goals = F.array("c_mktsegment", F.lit("any"))
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("customer"), pred.first_match(goals, rules, "low").alias("intensity"))


@query(
    "p16_calendar_filter",
    """SELECT event_id AS activity_id, 'c' || user_id % 3 AS city, strftime(ts, '%Y-%m-%d %H:%M:%S') AS start FROM events
    WHERE CAST(ts AS DATE) = DATE '2024-01-10' AND user_id % 3 = 1""",
)
def calendar_filter(spark, sf):
    acts = table(spark, sf, "events").select(
        F.col("event_id").alias("activity_id"), F.concat(F.lit("c"), (F.col("user_id") % 3).cast("string")).alias("city"), "ts"
    )
    out = pred.on_calendar(acts, "ts", day="2024-01-10", city="c1", valid=("2024-01-01", "2024-12-31"))
    return out.select("activity_id", "city", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("start"))


@query(
    "p19_null_tokens",
    """SELECT event_id, CASE WHEN event_type IN ('error', 'signup') THEN NULL ELSE event_type END AS cleaned FROM events""",
)
def null_tokens(spark, sf):
    t = F.col("event_type")
    raw = F.when(t == "error", "None").when(t == "signup", "").otherwise(t)
    return table(spark, sf, "events").select("event_id", pred.clean_null_token(raw).alias("cleaned"))


@query(
    "p20_negative_answers",
    """SELECT conv_id, turn, CASE WHEN contains(lower(text), 'the') OR contains(lower(text), 'nicht') THEN 'no answer' ELSE text END AS answer FROM conversations""",
)
def negative_answers(spark, sf):
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", pred.default_if_negative(F.col("text"), ["the", "Nicht"], "no answer").alias("answer")
    )


@query(
    "f23_allowed_labels",
    """SELECT o_orderkey AS request_id, CASE WHEN o_orderpriority IN ('2-HIGH', '1-URGENT') THEN lower(o_orderpriority) ELSE 'general_inquiry' END AS label FROM orders""",
)
def allowed_labels(spark, sf):
    answer = F.concat(F.lit("  "), F.col("o_orderpriority"), F.lit(" "))
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("request_id"), pred.allowed_label(answer, ["2-high", "1-urgent"], "general_inquiry").alias("label")
    )


@query(
    "e1_final_response",
    """SELECT doc_id, round((quality + CAST(n_chars > 100 AS INTEGER) + (1 - toxic)) / 3.0::DOUBLE, 6) AS score FROM documents JOIN labels USING (doc_id)""",
)
def final_response(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "n_chars").join(table(spark, sf, "labels"), "doc_id")
    judged = docs.select(
        "doc_id", (F.col("quality") == 1).alias("task_completed"), (F.col("n_chars") > 100).alias("format_correct"),
        (F.col("toxic") == 0).alias("instructions_followed"),
    )
    return op.final_response_score(judged).select("doc_id", F.round("score", 6).alias("score"))


@query(
    "e2_single_step",
    f"""WITH {MESSAGES_SQL}, {RUNS_SQL}, l AS (SELECT run_id, arg_max(tool, seq) AS tool, arg_max(arguments, seq) AS a FROM messages WHERE tool IS NOT NULL GROUP BY 1),
    j AS (SELECT run_id, tool IS NOT NULL AS called, coalesce(list_contains(expected_tools, tool), false) AS r, coalesce(a LIKE '%}}', false) AS v FROM runs LEFT JOIN l USING (run_id))
    SELECT run_id, called, r AS right_tool, v AS valid_arguments, round((2 * CAST(r AS INTEGER) + CAST(v AS INTEGER)) / 3.0::DOUBLE, 6) AS score FROM j""",
)
def single_step(spark, sf):
    return op.single_step_scores(derive.runs(spark, sf), derive.messages(spark, sf)).withColumn("score", F.round("score", 6))


@query(
    "e3_trajectory",
    f"""WITH {MESSAGES_SQL}, {RUNS_SQL},
    s AS (SELECT conv_id AS run_id, count(*) FILTER (turn > 0) AS n_steps FROM conversations WHERE conv_id % 7 <> 6 GROUP BY 1),
    m AS (SELECT run_id, count(tool) AS n_calls, list(DISTINCT tool) FILTER (tool IS NOT NULL) AS used,
          coalesce(bool_or(role = 'assistant' AND length(content) > 0), false) AS ans FROM messages GROUP BY 1),
    j AS (SELECT r.*, n_steps, n_calls, coalesce(list_has_any(used, expected_tools), false) AS u, coalesce(ans, false) AS ans,
          max_steps IS NULL OR n_steps <= max_steps AS lim FROM runs r LEFT JOIN s USING (run_id) LEFT JOIN m USING (run_id))
    SELECT run_id, n_steps IS NOT NULL AS ran, coalesce(n_steps, 0) AS n_steps, coalesce(n_calls, 0) AS n_calls,
      CASE WHEN n_steps IS NULL THEN 0.0 ELSE round((CAST(u AND lim AS INTEGER) + CAST(ans AS INTEGER) + 2 * CAST(u AS INTEGER)) / 4.0::DOUBLE, 6) END::DOUBLE AS score,
      CASE WHEN n_steps IS NULL THEN 0.0 ELSE round((ended - started) / greatest(coalesce(n_calls, 0), 1), 6) END::DOUBLE AS latency,
      round(total_tokens * (0.375::DOUBLE / 1000000), 9) AS cost FROM j""",
)
def trajectory(spark, sf):
    out = op.trajectory_scores(derive.runs(spark, sf), derive.messages(spark, sf), derive.snapshots(spark, sf))
    return out.withColumns({"score": F.round("score", 6), "latency": F.round("latency", 6), "cost": F.round("cost", 9)})


@query(
    "w10_last_tool_message",
    f"""WITH {MESSAGES_SQL} SELECT run_id, max(seq) AS seq, arg_max(tool, seq) AS tool FROM messages WHERE tool IS NOT NULL GROUP BY run_id""",
)
def last_tool_message(spark, sf):
    return op.last_tool_message(derive.messages(spark, sf)).select("run_id", "seq", F.col("tool_calls")[0]["name"].alias("tool"))


@query(
    "a13_token_totals",
    f"""WITH {MESSAGES_SQL} SELECT run_id, CAST(sum(total_tokens) AS BIGINT) AS tokens, round(sum(total_tokens) * (0.375::DOUBLE / 1000000), 9) AS cost FROM messages GROUP BY 1""",
)
def token_totals(spark, sf):
    return op.token_totals(derive.messages(spark, sf)).withColumn("cost", F.round("cost", 9))


@query(
    "w11_step_transitions",
    """SELECT user_id AS run_id, event_id AS seq, row_number() OVER w AS step_no, event_type AS step,
       lag(event_type) OVER w AS previous FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)""",
)
def step_transitions(spark, sf):
    steps = table(spark, sf, "events").select(F.col("user_id").alias("run_id"), F.col("event_id").alias("seq"), F.col("event_type").alias("step"))
    return op.step_transitions(steps, "run_id", "seq", "step", scans.id_slice("seq", 4096))


@query(
    "w11_run_durations",
    """SELECT user_id AS run_id, count(*) AS n_steps, epoch_us(max(ts)) - epoch_us(min(ts)) AS duration FROM events GROUP BY 1""",
)
def run_durations(spark, sf):
    steps = table(spark, sf, "events").select(F.col("user_id").alias("run_id"), F.col("event_type").alias("step"), F.unix_micros(F.col("ts").cast("timestamp")).alias("at"))
    return op.run_durations(steps, "run_id", "step", "at")


@query(
    "u2_tools_intersection",
    f"""WITH {MESSAGES_SQL}, {RUNS_SQL}, m AS (SELECT run_id, list(DISTINCT tool) AS used FROM messages WHERE tool IS NOT NULL GROUP BY 1)
    SELECT run_id, array_to_string(list_sort(list_intersect(used, expected_tools)), ',') AS common, len(list_intersect(used, expected_tools)) > 0 AS any_common
    FROM runs JOIN m USING (run_id)""",
)
def tools_intersection(spark, sf):
    used = op.tools_used(derive.messages(spark, sf)).filter(F.size("used") > 0)
    common = F.array_intersect("used", "expected_tools")
    rows = derive.runs(spark, sf).join(used, "run_id")
    return rows.select("run_id", F.array_join(F.array_sort(common), ",").alias("common"), (F.size(common) > 0).alias("any_common"))


@query(
    "u3_recipe_names",
    """SELECT name, min(origin) AS origin FROM (SELECT DISTINCT p_type AS name, 'base' AS origin FROM part UNION ALL SELECT DISTINCT p_name, 'custom' FROM part
    UNION ALL SELECT DISTINCT p_type, 'custom' FROM part WHERE p_size > 40) GROUP BY name""",
)
def recipe_names(spark, sf):
    part = table(spark, sf, "part")
    base = part.select(F.col("p_type").alias("name")).distinct()
    custom = part.select(F.col("p_name").alias("name")).unionByName(part.filter("p_size > 40").select(F.col("p_type").alias("name")))
    both = base.withColumn("origin", F.lit("base")).unionByName(custom.withColumn("origin", F.lit("custom")))
    return both.groupBy("name").agg(F.min("origin").alias("origin"))


@query(
    "j13_fan_out",
    """SELECT expert, o_orderstatus AS status, count(*) AS n FROM orders, (SELECT unnest(['legal', 'finance', 'market']) AS expert) GROUP BY 1, 2""",
)
def fan_out(spark, sf):
    rows = table(spark, sf, "orders").select(F.col("o_orderstatus").alias("status"))
    return pred.fan_out(rows, ["legal", "finance", "market"]).groupBy("expert", "status").agg(F.count("*").alias("n"))


@query(
    "j14_route_exact",
    """SELECT event_id, CASE event_type WHEN 'click' THEN 'clicks' WHEN 'view' THEN 'views' END AS handler,
       CASE WHEN event_type NOT IN ('click', 'view') THEN 'no handler for ' || event_type END AS error FROM events""",
)
def route_exact(spark, sf):
    out = pred.route_exact(table(spark, sf, "events"), "event_type", {"click": "clicks", "view": "views"})
    return out.select("event_id", "handler", "error")


@query(
    "j11_profile_by_substring",
    """WITH p AS (SELECT p_name, p_brand, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS rn, p_partkey FROM part),
    names AS (SELECT DISTINCT CAST(o_orderkey AS BIGINT) AS k, substr(o_orderpriority, 3, 2 + CAST(o_orderkey % 3 AS INTEGER)) AS asked FROM orders),
    prof AS (SELECT p_name AS profile, p_partkey AS ord, p_brand AS kind FROM p WHERE rn = 1),
    hit AS (SELECT a.asked, arg_min(kind, ord) AS kind FROM (SELECT DISTINCT asked FROM names) a JOIN prof ON contains(lower(profile), lower(a.asked)) GROUP BY 1)
    SELECT k AS request_id, coalesce(kind, 'Regular') AS kind FROM names LEFT JOIN hit USING (asked)""",
)
def profile_by_substring(spark, sf):
    key = F.col("o_orderkey")
    rows = table(spark, sf, "orders").select(key.alias("request_id"), F.substr(F.col("o_orderpriority"), F.lit(3), (key % 3 + 2).cast("int")).alias("asked"))
    first = table(spark, sf, "part").groupBy("p_name").agg(F.min("p_partkey").alias("ord"), F.min_by("p_brand", "p_partkey").alias("kind"))
    return pred.match_substring(rows, "asked", first, "p_name", "ord", "kind", "Regular").select("request_id", "kind")


@query(
    "a12_plan_totals",
    f"""WITH {ITEMS_SQL}, {PLANS_SQL} SELECT p.plan_id, total_cost, CAST(sum(price) AS BIGINT) AS computed, total_cost = sum(price) AS matches
    FROM plans p JOIN items USING (plan_id) GROUP BY 1, 2""",
)
def plan_totals(spark, sf):
    return trips.plan_totals(derive.items(spark, sf), derive.plans(spark, sf))


@query(
    "j7_catalog_differences",
    f"""WITH {ITEMS_SQL}, cat AS (SELECT event_id AS activity_id, CAST(floor(value) AS BIGINT) + CASE WHEN event_id % 9 = 0 THEN 1 ELSE 0 END AS price, event_type AS kind2
       FROM events WHERE event_type <> 'signup')
    SELECT plan_id, activity_id, CASE WHEN c.activity_id IS NULL THEN 'missing' ELSE 'mismatch' END AS kind
    FROM items i LEFT JOIN cat c USING (activity_id) WHERE c.activity_id IS NULL OR c.price <> i.price""",
)
def catalog_differences(spark, sf):
    items = derive.items(spark, sf).select("plan_id", "activity_id", "price", F.col("kind").alias("type"))
    cat = items.filter("type <> 'signup'").select(
        "activity_id", (F.col("price") + F.when(F.col("activity_id") % 9 == 0, 1).otherwise(0)).alias("price"), "type"
    )
    fresh = cat.select(*[F.col(c).alias(c) for c in cat.columns])
    return trips.catalog_differences(items, fresh, "activity_id", ["price", "type"]).select("plan_id", "activity_id", "kind")


HITS_SQL = f"""{ITEMS_SQL}, {TRAVELERS_SQL},
    hits AS (SELECT t.plan_id, t.traveler, count(i.activity_id) AS hits,
      coalesce(array_to_string(list_sort(list_distinct(flatten(list(list_intersect(t.interests, i.interests)) FILTER (i.activity_id IS NOT NULL)))), ','), '') AS matched
      FROM travelers t LEFT JOIN items i ON t.plan_id = i.plan_id AND list_has_any(t.interests, i.interests) GROUP BY 1, 2)"""


@query("j8_a15_interest_hits", f"WITH {HITS_SQL} SELECT * FROM hits")
def interest_hits(spark, sf):
    out = trips.interest_hits(derive.travelers(spark, sf), derive.items(spark, sf))
    return out.withColumn("matched", F.array_join("matched", ","))


@query(
    "j9_date_spine",
    f"""WITH {ITEMS_SQL}, {PLANS_SQL}, {WEATHER_SQL}, n AS (SELECT plan_id, day, count(*) AS n FROM items GROUP BY 1, 2),
    sp AS (SELECT plan_id, CAST(unnest(generate_series(start_date, end_date, INTERVAL 1 DAY)) AS DATE) AS day FROM plans)
    SELECT plan_id, CAST(day AS VARCHAR) AS day, coalesce(n, 0) AS n_activities, condition FROM sp LEFT JOIN n USING (plan_id, day) LEFT JOIN weather USING (day)""",
)
def date_spine(spark, sf):
    spine = trips.date_spine(derive.plans(spark, sf), "start_date", "end_date")
    n = derive.items(spark, sf).groupBy("plan_id", "day").agg(F.count("*").alias("n"))
    out = spine.join(n, ["plan_id", "day"], "left").join(derive.weather(spark, sf), "day", "left")
    return out.select("plan_id", F.col("day").cast("string").alias("day"), F.coalesce("n", F.lit(0)).alias("n_activities"), "condition")


@query(
    "e4_e5_e6_plan_checks",
    f"""WITH {ITEMS_SQL}, {PLANS_SQL}, c AS (SELECT plan_id, CAST(sum(price) AS BIGINT) AS computed FROM items GROUP BY 1),
    m AS (SELECT plan_id, CASE WHEN start_date <> start_date + CAST(plan_id % 2 AS INTEGER) THEN 'dates' END AS a,
      CASE WHEN total_cost > budget THEN 'budget' END AS b, CASE WHEN total_cost <> computed THEN 'total' END AS t,
      CASE WHEN total_cost > budget THEN 'over budget by ' || (total_cost - budget) END AS bm FROM plans JOIN c USING (plan_id))
    SELECT plan_id, a IS NULL AND b IS NULL AND t IS NULL AS success, concat_ws(',', a, b, t) AS failed_checks, coalesce(bm, '') AS budget_message FROM m""",
)
def plan_checks(spark, sf):
    computed = derive.items(spark, sf).groupBy("plan_id").agg(F.sum("price").alias("computed"))
    rows = derive.plans(spark, sf).join(computed, "plan_id")
    asked = F.date_add("start_date", (F.col("plan_id") % 2).cast("int"))
    out = op.run_checks(rows, {
        "dates": trips.date_check(F.col("start_date"), F.col("end_date"), asked, F.col("end_date")),
        "budget": trips.budget_check(F.col("total_cost"), F.col("budget")),
        "total": trips.total_check(F.col("total_cost"), F.col("computed")),
    })
    over = F.coalesce(F.get(F.filter("failures", lambda f: f.startswith("over budget")), F.lit(0)), F.lit(""))
    return out.select("plan_id", "success", F.array_join("failed_checks", ",").alias("failed_checks"), over.alias("budget_message"))


@query(
    "e7_catalog_consistency",
    f"""WITH {ITEMS_SQL} SELECT plan_id, count(*) FILTER (activity_id % 9 = 0) AS n_bad, count(*) FILTER (activity_id % 9 = 0) = 0 AS passed FROM items GROUP BY 1""",
)
def catalog_consistency(spark, sf):
    items = derive.items(spark, sf).select("plan_id", "activity_id", "price")
    cat = items.select(F.col("activity_id").alias("activity_id"), (F.col("price") + F.when(F.col("activity_id") % 9 == 0, 1).otherwise(0)).alias("price"))
    bad = trips.catalog_differences(items, cat, "activity_id", ["price"]).groupBy("plan_id").agg(F.count("*").alias("n"))
    out = items.select("plan_id").distinct().join(bad, "plan_id", "left")
    n = F.coalesce("n", F.lit(0))
    return out.select("plan_id", n.alias("n_bad"), (n == 0).alias("passed"))


@query(
    "e8_interest_coverage",
    f"WITH {HITS_SQL} SELECT plan_id, count(*) AS n_travelers, count(*) FILTER (hits = 0) AS n_without, count(*) FILTER (hits = 0) = 0 AS passed FROM hits GROUP BY 1",
)
def interest_coverage(spark, sf):
    hits = trips.interest_hits(derive.travelers(spark, sf), derive.items(spark, sf))
    out = hits.groupBy("plan_id").agg(F.count("*").alias("n_travelers"), F.count_if(F.col("hits") == 0).alias("n_without"))
    return out.withColumn("passed", F.col("n_without") == 0)


@query(
    "e9_weather_compatibility",
    f"""WITH {ITEMS_SQL}, {WEATHER_SQL}
    SELECT plan_id, count(*) AS n, count(*) FILTER (condition IN ('thunderstorm', 'rainy') AND kind <> 'view') AS n_conflicts FROM items JOIN weather USING (day) GROUP BY 1""",
)
def weather_compatibility(spark, sf):
    rows = derive.items(spark, sf).join(derive.weather(spark, sf), "day")
    text = F.when(F.col("kind") == "view", "Museum tour").otherwise("Walk in the park")
    msg = trips.weather_conflict(F.col("condition"), text)
    return rows.groupBy("plan_id").agg(F.count("*").alias("n"), F.count(msg).alias("n_conflicts"))


@query(
    "e12_required_fields",
    """SELECT o_orderkey AS request_id, CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'missing: requested_by' END AS message FROM orders""",
)
def required_fields(spark, sf):
    req = derive.requests(spark, sf)
    wrong = op.required_fields(req.schema, {"request_id": "bigint", "requested_by": "date"})
    if wrong:
        raise ValueError(wrong)
    return req.select("request_id", op.missing_values(["request_id", "requested_by"]).alias("message"))
