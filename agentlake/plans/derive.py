"""Derived inputs: the same definitions for Spark (functions) and SQL (text), all computed from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agentlake.core import table

SEED_CASH = 50000

# ---------------------------------------------------------------- ledger, inventory, requests
LEDGER_SQL = """ledger AS (
  SELECT l_orderkey * 10 + l_linenumber AS txn_id, l_partkey AS item,
         CASE WHEN l_returnflag = 'R' THEN 'sales' ELSE 'stock_orders' END AS txn_type,
         CAST(l_quantity AS BIGINT) AS units, CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
         CAST(l_shipdate AS DATE) AS txn_date
  FROM lineitem)"""

INVENTORY_SQL = """inventory AS (
  SELECT p_partkey AS item, p_name AS item_name, p_type AS category,
         CAST(p_retailprice AS DECIMAL(18,2)) AS unit_price, 50 + p_partkey % 100 AS min_stock_level
  FROM part)"""

CATALOG_SQL = """catalog AS (
  SELECT p_partkey AS item, p_type AS category, CAST(p_retailprice AS DECIMAL(18,2)) AS unit_price
  FROM part WHERE p_size <> 50)"""

REQUESTS_SQL = """requests AS (
  SELECT o_orderkey AS request_id, o_custkey AS customer, CAST(o_orderdate AS DATE) AS request_date,
         CASE WHEN o_orderstatus = 'F' THEN 'QUOTE' ELSE 'ORDER' END AS intent,
         CAST(CASE o_orderpriority WHEN '1-URGENT' THEN CAST(o_orderdate AS DATE)
              WHEN '2-HIGH' THEN CAST(o_orderdate AS DATE) + 1
              WHEN '3-MEDIUM' THEN CAST(o_orderdate AS DATE) + 4
              WHEN '5-LOW' THEN CAST(o_orderdate AS DATE) + 7 END AS DATE) AS requested_by
  FROM orders)"""

LINES_SQL = """lines AS (
  SELECT l_orderkey AS request_id, l_linenumber AS line_no, l_partkey AS item,
         (CAST(l_quantity AS BIGINT) - 1) * 25 AS quantity, CAST(l_shipdate AS DATE) AS ship_date
  FROM lineitem)"""


def ledger(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("txn_id"),
        F.col("l_partkey").alias("item"),
        F.when(F.col("l_returnflag") == "R", "sales").otherwise("stock_orders").alias("txn_type"),
        F.col("l_quantity").cast("long").alias("units"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
        F.col("l_shipdate").cast("date").alias("txn_date"),
    )


def inventory(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("item"),
        F.col("p_name").alias("item_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").cast("decimal(18,2)").alias("unit_price"),
        (F.lit(50) + F.col("p_partkey") % 100).alias("min_stock_level"),
    )


def catalog(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "part")
        .filter(F.col("p_size") != 50)
        .select(
            F.col("p_partkey").alias("item"),
            F.col("p_type").alias("category"),
            F.col("p_retailprice").cast("decimal(18,2)").alias("unit_price"),
        )
    )


def requests(spark: SparkSession, sf: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    pri = F.col("o_orderpriority")
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("request_id"),
        F.col("o_custkey").alias("customer"),
        day.alias("request_date"),
        F.when(F.col("o_orderstatus") == "F", "QUOTE").otherwise("ORDER").alias("intent"),
        F.when(pri == "1-URGENT", day)
        .when(pri == "2-HIGH", F.date_add(day, 1))
        .when(pri == "3-MEDIUM", F.date_add(day, 4))
        .when(pri == "5-LOW", F.date_add(day, 7))
        .alias("requested_by"),
    )


def request_lines(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("request_id"),
        F.col("l_linenumber").cast("long").alias("line_no"),
        F.col("l_partkey").alias("item"),
        ((F.col("l_quantity").cast("long") - 1) * 25).alias("quantity"),
        F.col("l_shipdate").cast("date").alias("ship_date"),
    )


# ---------------------------------------------------------------- bookings, tasks, purchases, recipes
BOOKINGS_SQL = """bookings AS (
  SELECT o_orderkey AS seq, o_custkey AS customer, CAST(o_orderdate AS DATE) AS day, o_custkey % 24 AS slot,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'deposit' WHEN '2-HIGH' THEN 'loan' WHEN '3-MEDIUM' THEN 'postal'
              WHEN '4-NOT SPECIFIED' THEN 'general_inquiry' ELSE 'bill_payment' END AS service,
         o_orderstatus = 'P' AS urgent
  FROM orders)"""

TASKS_SQL = """tasks AS (
  SELECT o_custkey AS batch, o_orderkey AS seq, 'Task-' || lpad(CAST((o_orderkey * 7919) % 1000003 AS VARCHAR), 9, '0') AS name,
         1 + CAST(floor(o_totalprice) AS BIGINT) % 10 AS complexity, 1 + (o_orderkey * 7) % 10 AS priority,
         CASE o_orderstatus WHEN 'P' THEN 'urgent' WHEN 'O' THEN 'normal' ELSE 'flexible' END AS deadline
  FROM orders)"""

PURCHASES_SQL = """purchases AS (
  SELECT o_custkey AS "user", l_partkey AS item, CAST(l_quantity AS BIGINT) AS units,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS cost, l_orderkey * 10 + l_linenumber AS seq
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

QUEUE_SQL = """queue AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer, CAST(o_orderdate AS DATE) AS order_date,
         1 + o_orderkey % 40 AS quantity,
         CASE o_orderpriority WHEN '1-URGENT' THEN 3 WHEN '2-HIGH' THEN 2 ELSE 1 END AS priority
  FROM orders)"""

RECIPES_SQL = """recipe AS (
  SELECT p_type AS product, p_brand AS ingredient, CAST(max(p_size) AS BIGINT) AS need FROM part GROUP BY 1, 2),
  ing_stock AS (SELECT p_brand AS ingredient, CAST(sum(l_quantity) AS BIGINT) // 20 AS amount
                FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1)"""

ENTRIES_SQL = """entries AS (
  SELECT user_id AS subject, event_id AS seq, CAST(floor(value) AS BIGINT) AS amount, event_type = 'error' AS flag,
         CAST(floor(value) AS BIGINT) % 8 AS want, CAST(ts AS DATE) AS day FROM events)"""


def bookings(spark: SparkSession, sf: str) -> DataFrame:
    pri = F.col("o_orderpriority")
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("seq"), F.col("o_custkey").alias("customer"),
        F.col("o_orderdate").cast("date").alias("day"), (F.col("o_custkey") % 24).alias("slot"),
        F.when(pri == "1-URGENT", "deposit").when(pri == "2-HIGH", "loan").when(pri == "3-MEDIUM", "postal")
        .when(pri == "4-NOT SPECIFIED", "general_inquiry").otherwise("bill_payment").alias("service"),
        (F.col("o_orderstatus") == "P").alias("urgent"),
    )


def tasks(spark: SparkSession, sf: str) -> DataFrame:
    key, st = F.col("o_orderkey"), F.col("o_orderstatus")
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("batch"), key.alias("seq"),
        F.concat(F.lit("Task-"), F.lpad(((key * 7919) % 1000003).cast("string"), 9, "0")).alias("name"),
        (F.floor("o_totalprice") % 10 + 1).alias("complexity"), ((key * 7) % 10 + 1).alias("priority"),
        F.when(st == "P", "urgent").when(st == "O", "normal").otherwise("flexible").alias("deadline"),
    )


def purchases(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("user"))
    return table(spark, sf, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "user", F.col("l_partkey").alias("item"), F.col("l_quantity").cast("long").alias("units"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("cost"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"),
    )


def queue(spark: SparkSession, sf: str) -> DataFrame:
    pri = F.col("o_orderpriority")
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer"),
        F.col("o_orderdate").cast("date").alias("order_date"), (F.col("o_orderkey") % 40 + 1).alias("quantity"),
        F.when(pri == "1-URGENT", 3).when(pri == "2-HIGH", 2).otherwise(1).alias("priority"),
    )


def recipes(spark: SparkSession, sf: str) -> DataFrame:
    need = table(spark, sf, "part").groupBy("p_type", "p_brand").agg(F.max("p_size").cast("long").alias("need"))
    return need.groupBy(F.col("p_type").alias("product")).agg(
        F.map_from_entries(F.collect_list(F.struct("p_brand", "need"))).alias("ingredients")
    )


def ingredient_stock(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").select("p_partkey", F.col("p_brand").alias("ingredient"))
    line = table(spark, sf, "lineitem").select("l_partkey", "l_quantity")
    return line.join(part, F.col("l_partkey") == F.col("p_partkey")).groupBy("ingredient").agg(
        F.floor(F.sum("l_quantity").cast("long") / 20).alias("amount")
    )


def entries(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        F.col("user_id").alias("subject"), F.col("event_id").alias("seq"), F.floor("value").alias("amount"),
        (F.col("event_type") == "error").alias("flag"), (F.floor("value") % 8).alias("want"),
        F.col("ts").cast("date").alias("day"),
    )


# ---------------------------------------------------------------- claims, patients, complaints, patterns
LEVEL_SQL = "CASE {x} % 5 WHEN 0 THEN 'public' WHEN 1 THEN 'customer' WHEN 2 THEN 'agent' WHEN 3 THEN 'financial' ELSE 'admin' END"

CLAIMS_SQL = f"""claims AS (
  SELECT 'CLM-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || strftime(l_shipdate, '%Y%m%d') AS claim_id,
         o_custkey AS patient_id, p_type AS code, CAST(floor(l_extendedprice) AS BIGINT) AS amount_cents,
         CASE l_linestatus WHEN 'F' THEN 'approved' ELSE 'pending' END AS status,
         {LEVEL_SQL.format(x='(l_orderkey + l_linenumber)')} AS privacy_level
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey)"""

PATIENTS_SQL = f"""patients AS (
  SELECT c_custkey AS patient_id, c_name AS name, c_mktsegment AS policy, {LEVEL_SQL.format(x='c_custkey')} AS privacy_level FROM customer)"""

COMPLAINTS_SQL = """complaint_log AS (
  SELECT event_id // 4 AS complaint_id, event_id AS seq, user_id AS claim_id,
         CASE WHEN event_id % 4 = 0 THEN 'open' WHEN event_type = 'purchase' THEN 'resolve' ELSE 'respond' END AS action,
         event_type || ' ' || props AS text FROM events)"""

TEXT_CLAIMS_SQL = f"""text_claims AS (
  SELECT doc_id AS id, text, source AS code, CAST(n_chars AS DOUBLE) AS amount, n_chars * 10 AS amount_cents, doc_id % 100 AS patient,
         {LEVEL_SQL.format(x='doc_id')} AS privacy_level FROM documents)"""

PATTERNS_SQL = f"""patterns AS (
  SELECT item_id AS query_id, text, 'src' || (item_id % 20) AS code, CAST(length(text) AS DOUBLE) AS amount, item_id % 100 AS patient,
         CASE item_id % 5 WHEN 0 THEN 'low' WHEN 1 THEN 'medium' WHEN 2 THEN 'high' WHEN 3 THEN 'critical' ELSE 'other' END AS severity,
         {LEVEL_SQL.format(x='item_id')} AS privacy_level FROM benchmark)"""


def level_of(x):
    m = x % 5
    return F.when(m == 0, "public").when(m == 1, "customer").when(m == 2, "agent").when(m == 3, "financial").otherwise("admin")


def claims(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("patient_id"))
    part = table(spark, sf, "part").select("p_partkey", F.col("p_type").alias("code"))
    line = table(spark, sf, "lineitem")
    return (
        line.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.concat_ws("-", F.lit("CLM"), "l_orderkey", "l_linenumber", "l_partkey", F.date_format("l_shipdate", "yyyyMMdd")).alias("claim_id"),
            "patient_id", "code", F.floor("l_extendedprice").alias("amount_cents"),
            F.when(F.col("l_linestatus") == "F", "approved").otherwise("pending").alias("status"),
            level_of(F.col("l_orderkey") + F.col("l_linenumber")).alias("privacy_level"),
        )
    )


def patients(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("patient_id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("policy"),
        level_of(F.col("c_custkey")).alias("privacy_level"),
    )


def complaint_log(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        F.floor(F.col("event_id") / 4).alias("complaint_id"), F.col("event_id").alias("seq"), F.col("user_id").alias("claim_id"),
        F.when(F.col("event_id") % 4 == 0, "open").when(F.col("event_type") == "purchase", "resolve").otherwise("respond").alias("action"),
        F.concat_ws(" ", "event_type", "props").alias("text"),
    )


def text_claims(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), "text", F.col("source").alias("code"), F.col("n_chars").cast("double").alias("amount"),
        (F.col("n_chars") * 10).alias("amount_cents"), (F.col("doc_id") % 100).alias("patient"),
        level_of(F.col("doc_id")).alias("privacy_level"),
    )


def patterns(spark: SparkSession, sf: str) -> DataFrame:
    m = F.col("item_id") % 5
    return table(spark, sf, "benchmark").select(
        F.col("item_id").alias("query_id"), "text", F.concat(F.lit("src"), (F.col("item_id") % 20).cast("string")).alias("code"),
        F.length("text").cast("double").alias("amount"), (F.col("item_id") % 100).alias("patient"),
        F.when(m == 0, "low").when(m == 1, "medium").when(m == 2, "high").when(m == 3, "critical").otherwise("other").alias("severity"),
        level_of(F.col("item_id")).alias("privacy_level"),
    )


# ---------------------------------------------------------------- vectors, sessions, memory
FIRST_OF_LABEL_SQL = """asked AS (SELECT label AS query_id, arg_min(embedding, vec_id) AS vec FROM embeddings GROUP BY label)"""
COSINE_SQL = "list_dot_product(CAST({a} AS DOUBLE[]), CAST({b} AS DOUBLE[])) / (sqrt(list_dot_product(CAST({a} AS DOUBLE[]), CAST({a} AS DOUBLE[]))) * sqrt(list_dot_product(CAST({b} AS DOUBLE[]), CAST({b} AS DOUBLE[]))))"


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"), "label")


def first_of_label(spark: SparkSession, sf: str) -> DataFrame:
    """The first vector of each label, as queries."""
    return table(spark, sf, "embeddings").groupBy(F.col("label").alias("query_id")).agg(
        F.min_by("embedding", "vec_id").alias("vec")
    )


def memory(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("label").alias("owner"),
        F.when(F.col("vec_id") % 3 == 0, "default").when(F.col("vec_id") % 3 == 1, "travel").otherwise("games").alias("namespace"),
        F.col("vec_id").alias("timestamp"), F.col("embedding").alias("vec"),
    )


# ---------------------------------------------------------------- runs, messages, plans, activities, weather
TOOLS = ("search", "lookup", "compute")
MESSAGES_SQL = """messages AS (
  SELECT conv_id AS run_id, turn AS seq, role, text AS content, length(text) // 4 AS total_tokens,
         CASE WHEN role = 'assistant' AND length(text) % 4 < 3 THEN ['search', 'lookup', 'compute'][1 + CAST(length(text) % 4 AS INTEGER)] END AS tool,
         CASE WHEN length(text) % 5 = 0 THEN '{"q": ' ELSE '{"q": 1}' END AS arguments
  FROM conversations)"""
RUNS_SQL = """runs AS (
  SELECT conv_id AS run_id, CASE conv_id % 3 WHEN 0 THEN ['search'] WHEN 1 THEN ['lookup', 'compute'] ELSE ['none'] END AS expected_tools,
         CASE WHEN conv_id % 4 = 0 THEN NULL ELSE 3 END AS max_steps, CAST(min(turn) AS DOUBLE) AS started, CAST(max(turn) * 2 AS DOUBLE) AS ended,
         CAST(sum(length(text) // 4) AS BIGINT) AS total_tokens
  FROM conversations GROUP BY conv_id)"""
ITEMS_SQL = """items AS (
  SELECT user_id AS plan_id, event_id AS activity_id, CAST(ts AS DATE) AS day, CAST(floor(value) AS BIGINT) AS price, event_type AS kind,
         [event_type, 'k' || CAST(json_extract_string(props, '$.k') AS BIGINT) % 7] AS interests FROM events)"""
PLANS_SQL = """plans AS (
  SELECT plan_id, min(day) AS start_date, max(day) AS end_date, CAST(sum(price) + CASE WHEN plan_id % 3 = 0 THEN 1 ELSE 0 END AS BIGINT) AS total_cost,
         900 + plan_id % 500 AS budget FROM items GROUP BY plan_id)"""
TRAVELERS_SQL = """travelers AS (
  SELECT c_custkey // 10 AS plan_id, c_custkey AS traveler,
         [['view', 'signup', 'hiking', 'error', 'purchase'][1 + CAST(c_custkey % 5 AS INTEGER)], 'k' || c_custkey % 9] AS interests FROM customer)"""
WEATHER_SQL = """weather AS (
  SELECT CAST(ts AS DATE) AS day, ['clear', 'partly cloudy', 'thunderstorm', 'rainy', 'sunny'][1 + CAST(count(*) % 5 AS INTEGER)] AS condition
  FROM events GROUP BY 1)"""


def messages(spark: SparkSession, sf: str) -> DataFrame:
    n = F.length("text")
    tool = F.element_at(F.array(*[F.lit(t) for t in TOOLS]), (n % 4 + 1).cast("int"))
    args = F.when(n % 5 == 0, '{"q": ').otherwise('{"q": 1}')
    call = F.array(F.struct(tool.alias("name"), args.alias("arguments")))
    none = F.array().cast("array<struct<name:string,arguments:string>>")
    return table(spark, sf, "conversations").select(
        F.col("conv_id").alias("run_id"), F.col("turn").alias("seq"), "role", F.col("text").alias("content"),
        F.floor(n / 4).alias("total_tokens"),
        F.when((F.col("role") == "assistant") & (n % 4 < 3), call).otherwise(none).alias("tool_calls"),
    )


def runs(spark: SparkSession, sf: str) -> DataFrame:
    m = F.col("conv_id") % 3
    lit = lambda *v: F.array(*[F.lit(x) for x in v])
    per = table(spark, sf, "conversations").groupBy("conv_id").agg(
        F.min("turn").cast("double").alias("started"), (F.max("turn") * 2).cast("double").alias("ended"),
        F.sum(F.floor(F.length("text") / 4)).alias("total_tokens"),
    )
    return per.select(
        F.col("conv_id").alias("run_id"), F.when(m == 0, lit("search")).when(m == 1, lit("lookup", "compute")).otherwise(lit("none")).alias("expected_tools"),
        F.when(F.col("conv_id") % 4 != 0, 3).alias("max_steps"), "started", "ended", "total_tokens",
    )


def snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """Runs with id under a multiple of seven never left a snapshot; first turns are entries."""
    rows = table(spark, sf, "conversations").filter(F.col("conv_id") % 7 != 6)
    return rows.select(F.col("conv_id").alias("run_id"), F.when(F.col("turn") == 0, "__entry__").otherwise(F.col("role")).alias("step_id"))


def items(spark: SparkSession, sf: str) -> DataFrame:
    k = (F.get_json_object("props", "$.k").cast("long") % 7).cast("string")
    return table(spark, sf, "events").select(
        F.col("user_id").alias("plan_id"), F.col("event_id").alias("activity_id"), F.col("ts").cast("date").alias("day"),
        F.floor("value").alias("price"), F.col("event_type").alias("kind"), F.array("event_type", F.concat(F.lit("k"), k)).alias("interests"),
    )


def plans(spark: SparkSession, sf: str) -> DataFrame:
    per = items(spark, sf).groupBy("plan_id").agg(F.min("day").alias("start_date"), F.max("day").alias("end_date"), F.sum("price").alias("s"))
    return per.select(
        "plan_id", "start_date", "end_date", (F.col("s") + F.when(F.col("plan_id") % 3 == 0, 1).otherwise(0)).alias("total_cost"),
        (F.lit(900) + F.col("plan_id") % 500).alias("budget"),
    )


def travelers(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("c_custkey")
    kinds = F.array(*[F.lit(x) for x in ("view", "signup", "hiking", "error", "purchase")])
    return table(spark, sf, "customer").select(
        F.floor(key / 10).alias("plan_id"), key.alias("traveler"),
        F.array(F.element_at(kinds, (key % 5 + 1).cast("int")), F.concat(F.lit("k"), (key % 9).cast("string"))).alias("interests"),
    )


def weather(spark: SparkSession, sf: str) -> DataFrame:
    names = F.array(*[F.lit(x) for x in ("clear", "partly cloudy", "thunderstorm", "rainy", "sunny")])
    return table(spark, sf, "events").groupBy(F.col("ts").cast("date").alias("day")).agg(
        F.element_at(names, (F.count("*") % 5 + 1).cast("int")).alias("condition")
    )
