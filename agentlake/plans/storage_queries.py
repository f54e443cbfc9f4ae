"""Queries that write, read back and compare rows: file-order ids, ledger appends, saved memory, nested plans, fixed tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from agentlake.core import table
from agentlake.operators import memory as mem
from agentlake.operators import neighbours as nn
from agentlake.operators import trips
from agentlake.plans import derive
from agentlake.plans.derive import LEDGER_SQL, PLANS_SQL, ITEMS_SQL
from agentlake.plans.registry import query
from agentlake.sources import files

FILE_BYTES = 32 << 20  # text of a file that is read whole, about


@query("s2_file_order_ids", """SELECT doc_id, lang, row_number() OVER (ORDER BY doc_id) AS row_id FROM documents""")
def file_order_ids(spark, sf):
    path = files.scratch_path(spark, "ordered")
    rows = table(spark, sf, "documents").select("doc_id", "lang", "text")
    # a file with texts over several lines is read by one task: more text makes more files
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    pieces = max(5, -(-size // FILE_BYTES))
    files.write_csv(rows.repartitionByRange(pieces, "doc_id").sortWithinPartitions("doc_id"), path)
    return files.read_requests(spark, path, rows.schema, row_id="row_id").select("doc_id", "lang", "row_id")


@query(
    "s6_ledger_append_read_back",
    f"""WITH {LEDGER_SQL}, t AS (SELECT txn_id, item, CASE WHEN txn_id % 11 = 0 THEN 'gift' WHEN txn_id % 13 <> 0 THEN txn_type END AS txn_type, units, price, txn_date FROM ledger)
    SELECT txn_id, item, txn_type, units, CAST(price AS DOUBLE) AS price, CAST(txn_date AS VARCHAR) AS txn_date, NULL AS reason FROM t WHERE txn_type IN ('sales', 'stock_orders')
    UNION ALL SELECT txn_id, item, txn_type, units, CAST(price AS DOUBLE), CAST(txn_date AS VARCHAR), 'unknown transaction type: ' || coalesce(txn_type, 'null')
    FROM t WHERE txn_type IS NULL OR txn_type NOT IN ('sales', 'stock_orders')""",
)
def ledger_append(spark, sf):
    """Two appends to one ledger folder; the rows on storage, and the rejected ones with their reason."""
    path = files.scratch_path(spark, "ledger")
    odd = F.when(F.col("txn_id") % 11 == 0, "gift").when(F.col("txn_id") % 13 != 0, F.col("txn_type"))
    rows = derive.ledger(spark, sf).withColumn("txn_type", odd)
    bad = [files.append_transactions(rows.filter(F.col("txn_id") % 2 == k), path) for k in (0, 1)]
    out = spark.read.parquet(path).withColumn("reason", F.lit(None).cast("string")).unionByName(bad[0]).unionByName(bad[1])
    return out.select("txn_id", "item", "txn_type", "units", F.col("price").cast("double").alias("price"), F.col("txn_date").cast("string").alias("txn_date"), "reason")


@query(
    "s11_dimension",
    """WITH d(o_orderpriority, level, days) AS (VALUES ('1-URGENT', 3, 1), ('2-HIGH', 2, 2), ('3-MEDIUM', 1, 5), ('4-NOT SPECIFIED', 0, NULL))
    SELECT o_orderkey AS order_id, CAST(level AS BIGINT) AS level, CAST(days AS BIGINT) AS days FROM orders LEFT JOIN d USING (o_orderpriority)""",
)
def dimension(spark, sf):
    rows = [("1-URGENT", 3, 1), ("2-HIGH", 2, 2), ("3-MEDIUM", 1, 5), ("4-NOT SPECIFIED", 0, None)]
    levels = files.dimension(spark, "o_orderpriority string, level long, days long", rows)
    return table(spark, sf, "orders").join(levels, "o_orderpriority", "left").select(F.col("o_orderkey").alias("order_id"), "level", "days")


@query(
    "a12_nested_plan_items",
    f"""WITH {ITEMS_SQL} SELECT plan_id, CAST(day AS VARCHAR) AS day, activity_id, price, kind FROM items""",
)
def nested_plan_items(spark, sf):
    """Activities nested by plan, day and recommendation, and unnested again."""
    items = derive.items(spark, sf)
    one = F.struct(F.struct("activity_id", "price", "kind").alias("activity"))
    days = items.groupBy("plan_id", "day").agg(F.collect_list(one).alias("recommendations"))
    plans = days.groupBy("plan_id").agg(F.collect_list(F.struct(F.col("day").alias("date"), "recommendations")).alias("itinerary_days"))
    out = trips.plan_items(plans, ["plan_id"])
    return out.select("plan_id", F.col("day").cast("string").alias("day"), "activity_id", "price", "kind")


@query(
    "a12_nested_plan_totals",
    f"""WITH {ITEMS_SQL}, {PLANS_SQL}, s AS (SELECT plan_id, CAST(sum(price) AS BIGINT) AS computed FROM items GROUP BY 1)
    SELECT plan_id, total_cost, computed, total_cost = computed AS matches FROM plans JOIN s USING (plan_id)""",
)
def nested_plan_totals(spark, sf):
    items = derive.items(spark, sf)
    one = F.struct(F.struct("activity_id", "price").alias("activity"))
    days = items.groupBy("plan_id", "day").agg(F.collect_list(one).alias("recommendations"))
    plans = days.groupBy("plan_id").agg(F.collect_list(F.struct(F.col("day").alias("date"), "recommendations")).alias("itinerary_days"))
    return trips.plan_totals(trips.plan_items(plans, ["plan_id"]), derive.plans(spark, sf))


@query(
    "v10_memory_save_and_register",
    """SELECT vec_id AS id, label AS owner, CASE vec_id % 3 WHEN 1 THEN 'travel' WHEN 2 THEN 'games' ELSE 'default' END AS namespace, vec_id AS timestamp FROM embeddings""",
)
def memory_save(spark, sf):
    """Fragments registered in two goes, those without a namespace under the default one; saved by namespace and read back."""
    path = files.scratch_path(spark, "memory")
    rows = derive.memory(spark, sf).withColumn("namespace", F.when(F.col("namespace") != "default", F.col("namespace")))
    empty = rows.filter("false").select(*rows.columns)
    first = mem.register(empty, rows.filter(F.col("id") % 2 == 0))
    mem.save_memory(first, path)
    mem.save_memory(mem.register(empty, rows.filter(F.col("id") % 2 == 1)), path)
    back = spark.read.parquet(path)
    return back.select("id", "owner", "namespace", "timestamp")


RECALL_SQL = """SELECT query_id, CAST(3 AS BIGINT) AS n, true AS recalled FROM (SELECT DISTINCT label % 5 AS query_id FROM embeddings)"""


def _recalled(vectors, near):
    """Rows per asked vector, and whether nine tenths of the exact answers are found, per fifth of the labels."""
    asked = vectors.select(F.col("id").alias("query_id"), "vec")
    near = near.select("query_id", "id", F.lit(1).alias("found"))
    exact = nn.nearest(vectors, asked, 3).select("query_id", "id", F.lit(1).alias("true"))
    both = exact.join(near, ["query_id", "id"], "full")
    per = both.groupBy("query_id").agg(F.sum("found").alias("n"), F.count_if((F.col("found") == 1) & (F.col("true") == 1)).alias("hit"))
    part = per.join(vectors.select(F.col("id").alias("query_id"), (F.col("label") % 5).alias("part")), "query_id")
    return part.groupBy(F.col("part").alias("query_id")).agg(F.max("n").alias("n"), (F.sum("hit") >= 0.9 * F.sum("n")).alias("recalled"))


@query("v16_recall", RECALL_SQL)
def recall(spark, sf):
    v = derive.vectors(spark, sf)
    return _recalled(v, nn.nearest_approximate(v, v.select(F.col("id").alias("query_id"), "vec"), dim=64, bits=4, k=3))


@query("v16_saved_index", RECALL_SQL)
def saved_index(spark, sf):
    """The index is written from one half of the vectors, the other half is appended, and all vectors are asked."""
    path = files.scratch_path(spark, "index")
    v = derive.vectors(spark, sf)
    nn.write_index(v.filter(F.col("id") % 2 == 0), path, dim=64, bits=4, folder_bits=2)
    nn.append_index(v.filter(F.col("id") % 2 != 0), path)
    return _recalled(v, nn.search_index(v.select(F.col("id").alias("query_id"), "vec"), path, k=3, probes=1))
