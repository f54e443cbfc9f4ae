"""Queue, booking, task-order, production and purchase queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from agentlake.core import table
from agentlake.functions import scalars as fn
from agentlake.operators import predicates as pred
from agentlake.operators import scans
from agentlake.operators import scheduling as op
from agentlake.plans import derive
from agentlake.plans.derive import BOOKINGS_SQL, ENTRIES_SQL, LEDGER_SQL, PURCHASES_SQL, QUEUE_SQL, RECIPES_SQL, TASKS_SQL
from agentlake.plans.registry import query

# fixed values: slots per service; the general inquiry has no limit
SLOTS = {"deposit": 500, "loan": 700, "postal": 900, "bill_payment": 1100}
SLOTS_SQL = "CASE service " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in SLOTS.items()) + " END"
ETA = "greatest(1, CAST(floor(CASE WHEN {p} = 3 THEN 1.0 WHEN {p} = 2 THEN greatest(1.0, greatest(1.0, {v} / 10.0) / 2) ELSE greatest(1.0, {v} / 10.0) END) AS BIGINT) + 1)"


def capacity(spark):
    rows = spark.range(1).select(
        F.explode(F.array(*[F.struct(F.lit(k).alias("service"), F.lit(v).alias("slots")) for k, v in SLOTS.items()],
                          F.struct(F.lit("general_inquiry").alias("service"), F.lit(None).cast("int").alias("slots")))).alias("s")
    )
    return rows.select("s.service", "s.slots")


@query(
    "w5_first_come_capacity",
    f"""WITH {BOOKINGS_SQL}, p AS (SELECT *, row_number() OVER (PARTITION BY service ORDER BY seq) AS place FROM bookings)
    SELECT seq, service, place, coalesce(place <= {SLOTS_SQL}, true) AS accepted FROM p""",
)
def first_come(spark, sf):
    out = op.first_come(derive.bookings(spark, sf), capacity(spark))
    return out.select("seq", "service", "place", "accepted")


@query(
    "w6_one_per_slot",
    f"""WITH {BOOKINGS_SQL} SELECT CAST(day AS VARCHAR) AS day, slot, min(seq) AS seq, arg_min(customer, seq) AS customer
    FROM bookings GROUP BY day, slot""",
)
def one_per_slot(spark, sf):
    out = op.one_per_slot(derive.bookings(spark, sf), ["day", "slot"], "seq")
    return out.select(F.col("day").cast("string").alias("day"), "slot", "seq", "customer")


@query(
    "a17_bookings_by_day",
    f"""WITH {BOOKINGS_SQL}, w AS (SELECT day, slot, arg_min(customer, seq) AS customer FROM bookings GROUP BY 1, 2)
    SELECT CAST(day AS VARCHAR) AS day,
           string_agg(CAST(slot AS VARCHAR) || '=' || CAST(customer AS VARCHAR), ',' ORDER BY slot) AS bookings
    FROM w GROUP BY 1""",
)
def bookings_by_day(spark, sf):
    out = op.bookings_by_day(derive.bookings(spark, sf), "day", "slot", "customer", "seq")
    pairs = F.transform(F.map_entries("bookings"), lambda e: F.concat(e["key"].cast("string"), F.lit("="), e["value"].cast("string")))
    return out.select(F.col("day").cast("string").alias("day"), F.array_join(pairs, ",").alias("bookings"))


@query(
    "a16_booking_listing",
    f"""WITH {BOOKINGS_SQL}, n AS (SELECT *, row_number() OVER (PARTITION BY service ORDER BY seq) AS rn FROM bookings)
    SELECT service, (rn - 1) // 100 AS page, count(*) AS n,
           string_agg(CAST(customer AS VARCHAR) || CASE WHEN urgent THEN ' (URGENT)' ELSE '' END, '; ' ORDER BY rn) AS listing
    FROM n GROUP BY 1, 2""",
)
def booking_listing(spark, sf):
    text = F.concat(F.col("customer").cast("string"), F.when(F.col("urgent"), " (URGENT)").otherwise(""))
    return op.booking_pages(derive.bookings(spark, sf), "service", "seq", text, page_rows=100)


@query(
    "f21_confirmation",
    f"""WITH {BOOKINGS_SQL}
    SELECT seq, c_name || '''s ' || service || ' service booking is confirmed' || CASE WHEN urgent THEN ' URGENTLY' ELSE '' END ||
      CASE WHEN (c_mktsegment = 'BUILDING' AND service IN ('deposit', 'loan')) OR (c_mktsegment = 'MACHINERY' AND service = 'bill_payment')
           THEN ' with ' || c_mktsegment || ' priority service' ELSE '' END || '.' AS message
    FROM bookings JOIN customer ON c_custkey = customer""",
)
def confirmation(spark, sf):
    cust = table(spark, sf, "customer").select(F.col("c_custkey").alias("customer"), "c_name", "c_mktsegment")
    special = {"BUILDING": ["deposit", "loan"], "MACHINERY": ["bill_payment"]}
    kind = F.col("c_mktsegment")
    services = F.coalesce(fn.value_of({k: v for k, v in special.items()}, kind, []), F.array())
    rows = derive.bookings(spark, sf).join(cust, "customer")
    message = fn.booking_confirmation(F.col("c_name"), F.col("service"), F.col("urgent"), F.array_contains(services, F.col("service")), kind)
    return rows.select("seq", message.alias("message"))


@query(
    "w7_sequence_ids",
    """SELECT o_orderkey AS seq, 'ORD-' || CASE WHEN rn < 1000 THEN lpad(CAST(rn AS VARCHAR), 4, '0') ELSE CAST(rn AS VARCHAR) END AS order_id
    FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS rn FROM orders)""",
)
def sequence_ids(spark, sf):
    return op.sequence_ids(derive.bookings(spark, sf).select("seq"), "seq")


@query(
    "w8_task_order_deterministic",
    f"""WITH {TASKS_SQL},
    p AS (SELECT *, row_number() OVER (PARTITION BY batch ORDER BY priority DESC, seq) AS p FROM tasks),
    l AS (SELECT *, coalesce(max(CASE WHEN deadline = 'urgent' OR priority >= 8 THEN p END) OVER (PARTITION BY batch), 0) AS l FROM p)
    SELECT batch, seq, CASE WHEN p <= l THEN p ELSE l + row_number() OVER (PARTITION BY batch, p <= l ORDER BY complexity, seq) END AS place
    FROM l""",
)
def task_order(spark, sf):
    return op.order_deterministic(derive.tasks(spark, sf)).select("batch", "seq", "place")


@query(
    "w9_task_order_by_size",
    f"""WITH {TASKS_SQL},
    c AS (SELECT *, row_number() OVER (PARTITION BY batch ORDER BY complexity, seq) AS c, count(*) OVER (PARTITION BY batch) AS n FROM tasks)
    SELECT batch, seq, CASE WHEN c <= n - 3 THEN c
      ELSE greatest(n - 3, 0) + row_number() OVER (PARTITION BY batch, c <= n - 3 ORDER BY priority DESC, seq) END AS place FROM c""",
)
def task_order_size(spark, sf):
    return op.order_by_size(derive.tasks(spark, sf)).select("batch", "seq", "place")


@query(
    "w9_task_order_fixed",
    f"""WITH {TASKS_SQL} SELECT batch, name,
    row_number() OVER (PARTITION BY batch ORDER BY CASE WHEN complexity < 5 THEN 0 ELSE 1 END, name) AS place FROM tasks""",
)
def task_order_fixed(spark, sf):
    by_name = F.floor(F.substring("name", 6, 9).cast("long") / 1000)
    return op.order_fixed(derive.tasks(spark, sf), "batch", "name", by_name).select("batch", "name", "place")


@query(
    "w13_supply_grants",
    f"""WITH {ENTRIES_SQL}, w AS (SELECT day, seq, least(greatest(want, 0), 5) AS w, want FROM entries)
    SELECT CAST(day AS VARCHAR) AS day, seq, want, CAST(greatest(0, least(w, 300 - coalesce(sum(w) OVER (PARTITION BY day ORDER BY seq
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) AS BIGINT) AS granted FROM w""",
)
def supply_grants(spark, sf):
    wants = derive.entries(spark, sf).select("day", "seq", "want")
    out = op.supply_grants(wants, ["day"], "seq", 300)
    return out.select(F.col("day").cast("string").alias("day"), "seq", "want", "granted")


@query(
    "w2_recent_history",
    f"""WITH {ENTRIES_SQL}
    SELECT subject, seq, row_number() OVER w AS entry_no, bool_or(flag) OVER w AS ever,
      CAST(sum(amount) OVER (PARTITION BY subject ORDER BY seq ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS BIGINT) AS recent_sum
    FROM entries WINDOW w AS (PARTITION BY subject ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def recent_history(spark, sf):
    out = op.recent_history(derive.entries(spark, sf), "subject", "seq", "amount", "flag")
    return out.select("subject", "seq", "entry_no", "ever", "recent_sum")


@query(
    "a9_decisions_per_subject",
    f"""WITH {ENTRIES_SQL} SELECT subject, count(*) AS n, CAST(sum(amount) AS BIGINT) AS total,
    count(*) FILTER (flag) AS n_flagged FROM entries GROUP BY subject""",
)
def decisions(spark, sf):
    return op.decisions_per_subject(derive.entries(spark, sf), "subject", "amount", "flag")


@query(
    "a7_purchase_summary",
    f"""WITH {PURCHASES_SQL},
    i AS (SELECT "user", item, sum(cost) AS c, count(*) AS n, sum(units) AS u, min(seq) AS f FROM purchases GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY u DESC, f, item) AS rn FROM i)
    SELECT "user", CAST(sum(c) AS DOUBLE) AS spent, CAST(sum(n) AS BIGINT) AS n_purchases, CAST(sum(u) AS BIGINT) AS units,
           max(CASE WHEN rn = 1 THEN item END) AS top_item, CAST(max(CASE WHEN rn = 1 THEN u END) AS BIGINT) AS top_units
    FROM r GROUP BY "user" """,
)
def purchase_summary(spark, sf):
    return op.purchase_summary(derive.purchases(spark, sf)).withColumn("spent", F.col("spent").cast("double"))


@query(
    "p21_ordered_listing",
    f"""WITH {PURCHASES_SQL} SELECT "user", seq, item, row_number() OVER (PARTITION BY "user" ORDER BY seq, item, units, cost) AS place FROM purchases""",
)
def ordered_listing(spark, sf):
    rows = derive.purchases(spark, sf)
    out = scans.numbered(rows, ["user"], ["seq", "item", "units", "cost"], scans.id_slice("seq", 4096), "place")
    return out.select("user", "seq", "item", "place")


@query(
    "a8_queue_load",
    f"""WITH {QUEUE_SQL} SELECT CAST(order_date AS VARCHAR) AS order_date, count(*) AS n_orders, CAST(sum(quantity) AS BIGINT) AS volume,
    greatest(1.0, CAST(sum(quantity) AS DOUBLE) / 10) AS days, count(*) FILTER (priority > 1) AS n_pressing,
    CAST(coalesce(sum(quantity) FILTER (priority > 1), 0) AS BIGINT) AS pressing_volume FROM queue GROUP BY 1""",
)
def queue_load(spark, sf):
    return op.queue_load(derive.queue(spark, sf), ["order_date"]).withColumn("order_date", F.col("order_date").cast("string"))


@query(
    "f4_queue_eta",
    f"""WITH {QUEUE_SQL} SELECT order_id, {ETA.format(p='priority', v='quantity')} AS days,
    CAST(order_date + CAST({ETA.format(p='priority', v='quantity')} AS INTEGER) AS VARCHAR) AS ready_date FROM queue""",
)
def queue_eta(spark, sf):
    days = fn.eta_days(F.col("quantity"), F.col("priority"))
    return derive.queue(spark, sf).select(
        "order_id", days.alias("days"), F.date_add("order_date", days.cast("int")).cast("string").alias("ready_date")
    )


@query(
    "f4_queue_volume_eta",
    f"""WITH {QUEUE_SQL}, v AS (SELECT CAST(sum(quantity) AS BIGINT) AS volume FROM queue)
    SELECT order_id, {ETA.format(p='priority', v='volume')} AS days FROM queue, v""",
)
def queue_volume_eta(spark, sf):
    """Days until an order that joins the whole queue is ready."""
    queue = derive.queue(spark, sf)
    volume = queue.agg(F.sum("quantity").alias("volume")).scalar()
    return queue.withColumn("volume", volume).select("order_id", fn.eta_days(F.col("volume"), F.col("priority")).alias("days"))


@query(
    "f5_complexity_lead_time",
    f"""WITH {QUEUE_SQL} SELECT order_id, CAST(CASE WHEN priority > 1 THEN 3 ELSE 1 END * greatest(1, quantity // 2) AS BIGINT) AS days FROM queue""",
)
def complexity_lead_time(spark, sf):
    q = derive.queue(spark, sf)
    return q.select("order_id", fn.complexity_days(F.col("priority") > 1, F.col("quantity")).alias("days"))


@query(
    "w12_reprioritize",
    f"""WITH {QUEUE_SQL},
    u AS (SELECT event_id // 2 AS order_id, event_id AS seq, CAST(json_extract_string(props, '$.k') AS BIGINT) % 5 AS np FROM events),
    l AS (SELECT order_id, arg_max(np, seq) AS np FROM u WHERE np IN (1, 2, 3) GROUP BY 1),
    v AS (SELECT CAST(sum(quantity) AS BIGINT) AS vol FROM queue)
    SELECT order_id, CAST(priority AS BIGINT) AS old_priority, np AS new_priority,
      CAST(order_date + CAST({ETA.format(p='np', v='vol')} AS INTEGER) AS VARCHAR) AS ready_date
    FROM queue JOIN l USING (order_id), v""",
)
def reprioritize(spark, sf):
    upd = table(spark, sf, "events").select(
        F.floor(F.col("event_id") / 2).alias("order_id"), F.col("event_id").alias("seq"),
        (F.get_json_object("props", "$.k").cast("long") % 5).alias("priority"),
    )
    out = op.reprioritize(derive.queue(spark, sf), upd)
    return out.select("order_id", F.col("old_priority").cast("long").alias("old_priority"), "new_priority",
                      F.col("ready_date").cast("string").alias("ready_date"))


@query(
    "j10_recipe_sufficiency",
    f"""WITH {RECIPES_SQL}, o AS (SELECT l_orderkey * 10 + l_linenumber AS order_id, l_partkey, CAST(l_shipdate AS DATE) AS d,
           p_type AS product, CAST(l_quantity AS BIGINT) * 8 AS quantity FROM lineitem JOIN part ON p_partkey = l_partkey),
    need AS (SELECT product, q, bool_and(coalesce(amount, 0) >= need * q) AS ok
             FROM (SELECT DISTINCT product, quantity AS q FROM o) JOIN recipe USING (product) LEFT JOIN ing_stock USING (ingredient) GROUP BY 1, 2)
    SELECT order_id, l_partkey AS part, CAST(d AS VARCHAR) AS day, o.product, ok AS sufficient
    FROM o JOIN need ON need.product = o.product AND need.q = o.quantity""",
)
def recipe_sufficiency(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", F.col("p_type").alias("product"))
    orders = table(spark, sf, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_id"), F.col("l_partkey").alias("part"),
        F.col("l_shipdate").cast("date").cast("string").alias("day"), "product", (F.col("l_quantity").cast("long") * 8).alias("quantity"),
    )
    out = op.sufficiency(orders, derive.recipes(spark, sf), derive.ingredient_stock(spark, sf))
    return out.select("order_id", "part", "day", "product", "sufficient")


@query(
    "j12_referential_checks",
    """SELECT l_orderkey * 10 + l_linenumber AS txn_id, l_partkey AS item, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS day
    FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <> 50)
       OR l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')""",
)
def referential(spark, sf):
    line = table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("txn_id"), "l_orderkey", F.col("l_partkey").alias("item"),
        F.col("l_shipdate").cast("date").cast("string").alias("day"),
    )
    orders = table(spark, sf, "orders").filter(F.col("o_orderstatus") != "P").select(F.col("o_orderkey").alias("l_orderkey"))
    no_item = line.join(derive.catalog(spark, sf), "item", "left_anti")
    no_order = line.join(derive.catalog(spark, sf), "item", "left_semi").join(orders, "l_orderkey", "left_anti")
    return no_item.unionByName(no_order).select("txn_id", "item", "day")


UPDATES_SQL = """s AS (SELECT l_partkey AS item, CAST(sum(l_quantity) AS BIGINT) AS amount FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1),
    u AS (SELECT event_id % 3000 AS item, event_id AS seq, CASE WHEN event_type = 'click' THEN 'set' ELSE 'add' END AS kind,
                 CAST(floor(value) AS BIGINT) AS amount FROM events)"""


def _stock_and_updates(spark, sf):
    stock = table(spark, sf, "lineitem").filter(F.col("l_returnflag") != "R").groupBy(F.col("l_partkey").alias("item")).agg(
        F.sum("l_quantity").cast("long").alias("amount")
    )
    upd = table(spark, sf, "events").select(
        (F.col("event_id") % 3000).alias("item"), F.col("event_id").alias("seq"),
        F.when(F.col("event_type") == "click", "set").otherwise("add").alias("kind"), F.floor("value").alias("amount"),
    )
    return stock, upd


@query(
    "x5_stock_updates",
    f"""WITH {UPDATES_SQL},
    st AS (SELECT item, max(seq) AS ls, arg_max(amount, seq) AS base FROM u WHERE kind = 'set' GROUP BY 1),
    ad AS (SELECT u.item, sum(u.amount) AS delta FROM u LEFT JOIN st USING (item) WHERE kind = 'add' AND (ls IS NULL OR u.seq > ls) GROUP BY 1)
    SELECT item, amount AS old_amount, CAST(coalesce(base, amount) + coalesce(delta, 0) AS BIGINT) AS new_amount
    FROM s LEFT JOIN st USING (item) LEFT JOIN ad USING (item)""",
)
def stock_updates(spark, sf):
    return op.stock_after_updates(*_stock_and_updates(spark, sf))


@query("x5_rejected_updates", f"WITH {UPDATES_SQL} SELECT item, seq, kind, amount FROM u WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.item = u.item)")
def rejected_updates(spark, sf):
    return op.rejected_updates(*_stock_and_updates(spark, sf)).select("item", "seq", "kind", "amount")


@query(
    "p22_lookup_default",
    f"""WITH {LEDGER_SQL}, s AS (SELECT item, CAST(sum(units) AS BIGINT) AS sold FROM ledger WHERE txn_type = 'sales' GROUP BY 1)
    SELECT p_partkey AS item, coalesce(sold, 0) AS sold FROM part LEFT JOIN s ON item = p_partkey""",
)
def lookup_default(spark, sf):
    sold = derive.ledger(spark, sf).filter(F.col("txn_type") == "sales").groupBy("item").agg(F.sum("units").alias("sold"))
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("item"))
    return pred.lookup_default(parts, sold, "item", {"sold": 0})


@query(
    "f22_power_product",
    """SELECT p_partkey AS item, round(pow(p_size, 2), 6) AS squared, round(p_size * p_retailprice, 6) AS product FROM part""",
)
def power_product(spark, sf):
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("item"), F.round(F.pow("p_size", F.lit(2)), 6).alias("squared"),
        F.round(F.col("p_size") * F.col("p_retailprice"), 6).alias("product"),
    )
