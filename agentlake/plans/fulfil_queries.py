"""Request, pricing and fulfilment queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from agentlake.functions import scalars as fn
from agentlake.operators import fulfil as op
from agentlake.operators import predicates as pred
from agentlake.plans import derive
from agentlake.plans.derive import CATALOG_SQL, INVENTORY_SQL, LEDGER_SQL, LINES_SQL, REQUESTS_SQL
from agentlake.plans.registry import query

LEAD = "CASE WHEN {q} <= 10 THEN 0 WHEN {q} <= 100 THEN 1 WHEN {q} <= 1000 THEN 4 ELSE 7 END"
PCT = "CASE WHEN {q} < 100 THEN 0 WHEN {q} < 500 THEN 5 WHEN {q} < 1000 THEN 10 ELSE 15 END"
SIGNED = "CASE WHEN txn_type = 'stock_orders' THEN units ELSE -units END"


def half_even(numerator: str) -> str:
    """Whole cents from hundredths of cents, half to even."""
    n = f"({numerator})"
    return f"({n} // 100 + CASE WHEN {n} % 100 > 50 OR ({n} % 100 = 50 AND ({n} // 100) % 2 = 1) THEN 1 ELSE 0 END)"


CUM_SQL = f"""daily AS (SELECT item, txn_date, sum({SIGNED}) AS net FROM ledger GROUP BY 1, 2),
  cum AS (SELECT item, txn_date, CAST(sum(net) OVER (PARTITION BY item ORDER BY txn_date) AS BIGINT) AS stock FROM daily)"""

QUOTED_SQL = f"""{LEDGER_SQL}, {LINES_SQL}, {REQUESTS_SQL}, {CATALOG_SQL}, {INVENTORY_SQL}, {CUM_SQL},
  wide AS (SELECT l.request_id, l.line_no, l.item, l.ship_date, l.quantity, r.request_date, r.intent, r.requested_by,
                  c.unit_price, CAST(c.unit_price * 100 AS BIGINT) AS unit_cents,
                  CASE WHEN l.quantity <= 0 THEN 'Invalid quantity or missing item name.'
                       WHEN c.item IS NULL THEN 'Unknown item (not in catalog).' END AS bad
           FROM lines l JOIN requests r USING (request_id) LEFT JOIN catalog c ON c.item = l.item),
  stocked AS (SELECT w.*, coalesce(s.stock, 0) AS available FROM wide w
              ASOF LEFT JOIN cum s ON w.item = s.item AND w.request_date >= s.txn_date),
  priced AS (SELECT *, CASE WHEN bad IS NULL THEN greatest(0, quantity - available) END AS shortage,
                    unit_cents * quantity AS sub_cents,
                    {half_even(f"unit_cents * quantity * ({PCT.format(q='quantity')})")} AS disc_cents FROM stocked),
  timed AS (SELECT *, CASE WHEN bad IS NULL AND shortage > 0
                      THEN request_date + CAST({LEAD.format(q='shortage')} AS INTEGER) ELSE request_date END AS delivery_date
            FROM priced),
  quoted AS (SELECT *, CASE WHEN bad IS NOT NULL THEN 0 ELSE sub_cents - disc_cents END AS total_cents,
                    CASE WHEN bad IS NOT NULL THEN 'INVALID'
                         WHEN requested_by IS NOT NULL AND delivery_date > requested_by THEN 'NOT_FULFILLED'
                         ELSE 'FULFILLED' END AS status,
                    CASE WHEN bad IS NOT NULL THEN bad
                         WHEN requested_by IS NOT NULL AND delivery_date > requested_by
                         THEN 'Requested delivery date cannot be met. Earliest possible: ' || CAST(delivery_date AS VARCHAR) || '.'
                         WHEN shortage > 0 THEN 'Supplier lead time required due to shortage.' ELSE '' END AS reason
             FROM timed),
  overall AS (SELECT r.request_id, r.intent,
                     CASE coalesce(max(CASE q.status WHEN 'INVALID' THEN 3 WHEN 'NOT_FULFILLED' THEN 2 ELSE 1 END), 3)
                          WHEN 3 THEN 'INVALID' WHEN 2 THEN 'NOT_FULFILLED' ELSE 'FULFILLED' END AS overall_status,
                     count(q.request_id) AS n_lines, coalesce(sum(q.total_cents), 0) AS cents
              FROM requests r LEFT JOIN quoted q ON q.request_id = r.request_id AND q.status IS NOT NULL
              GROUP BY r.request_id, r.intent)"""
# a request without lines has no quoted row: count 0 and status INVALID
OVERALL_FIX = "CASE WHEN n_lines = 0 THEN 'INVALID' ELSE overall_status END"


def quoted(spark, sf):
    return op.quote_lines(
        derive.request_lines(spark, sf), derive.requests(spark, sf), derive.catalog(spark, sf), derive.ledger(spark, sf)
    )


@query(
    "x1_quote_lines",
    f"""WITH {QUOTED_SQL}
    SELECT request_id, line_no, item, CAST(ship_date AS VARCHAR) AS ship_date, status, reason, shortage,
           CAST(delivery_date AS VARCHAR) AS delivery_date, CAST(total_cents AS DOUBLE) / 100 AS total_price FROM quoted""",
)
def quote_lines(spark, sf):
    return quoted(spark, sf).select(
        "request_id", "line_no", "item", F.col("ship_date").cast("string").alias("ship_date"), "status", "reason", "shortage",
        F.col("delivery_date").cast("string").alias("delivery_date"), F.col("total_price").cast("double").alias("total_price"),
    )


@query(
    "a6_overall_status",
    f"""WITH {QUOTED_SQL}
    SELECT request_id, {OVERALL_FIX} AS overall_status, n_lines, CAST(cents AS DOUBLE) / 100 AS total_price FROM overall""",
)
def overall_status(spark, sf):
    out = op.overall_status(quoted(spark, sf), derive.requests(spark, sf))
    return out.select("request_id", "overall_status", "n_lines", F.col("total_price").cast("double").alias("total_price"))


@query(
    "f9_customer_message",
    f"""WITH {QUOTED_SQL}, o AS (SELECT request_id, intent, {OVERALL_FIX} AS st FROM overall)
    SELECT request_id, CASE WHEN st = 'INVALID' THEN 'Your request could not be processed due to invalid item information.'
        WHEN intent = 'QUOTE' THEN 'Here is your quote with pricing and estimated delivery dates.'
        WHEN intent = 'ORDER' AND st = 'FULFILLED' THEN 'Your order has been successfully placed.'
        WHEN intent = 'ORDER' AND st = 'NOT_FULFILLED' THEN 'We cannot meet your requested delivery date. Here is a counter-offer.'
        ELSE 'Request processed.' END AS message FROM o""",
)
def customer_message(spark, sf):
    return op.overall_status(quoted(spark, sf), derive.requests(spark, sf)).select("request_id", "message")


@query(
    "x2_ledger_writes",
    f"""WITH {QUOTED_SQL}, placed AS (SELECT request_id FROM overall WHERE intent = 'ORDER' AND {OVERALL_FIX} = 'FULFILLED'),
    base AS (SELECT q.request_id, q.line_no, q.item, q.ship_date, q.quantity, q.shortage, q.delivery_date, q.total_cents,
                    CAST(i.unit_price * 100 AS BIGINT) AS uc, i.min_stock_level
             FROM quoted q JOIN placed USING (request_id) JOIN inventory i ON i.item = q.item),
    atd AS (SELECT b.*, coalesce(s.stock, 0) + b.shortage - b.quantity AS after FROM base b
           ASOF LEFT JOIN cum s ON b.item = s.item AND b.delivery_date >= s.txn_date),
    re AS (SELECT *, CASE WHEN after < min_stock_level THEN greatest(2 * min_stock_level - after, quantity) END AS reorder FROM atd)
    SELECT request_id, line_no, item, CAST(ship_date AS VARCHAR) AS ship_date, CAST(step AS BIGINT) AS step, txn_type,
           CAST(units AS BIGINT) AS units, CAST(cents AS DOUBLE) / 100 AS price, CAST(d AS VARCHAR) AS txn_date FROM (
      SELECT request_id, line_no, item, ship_date, 1 AS step, 'stock_orders' AS txn_type, shortage AS units,
             shortage * uc AS cents, delivery_date AS d FROM re WHERE shortage > 0
      UNION ALL SELECT request_id, line_no, item, ship_date, 2, 'sales', quantity, total_cents, delivery_date FROM re
      UNION ALL SELECT request_id, line_no, item, ship_date, 3, 'stock_orders', reorder, reorder * uc,
             delivery_date + CAST({LEAD.format(q='reorder')} AS INTEGER) FROM re WHERE reorder IS NOT NULL)""",
)
def ledger_writes(spark, sf):
    out = op.place_orders(
        derive.request_lines(spark, sf), derive.requests(spark, sf), derive.catalog(spark, sf), derive.inventory(spark, sf), derive.ledger(spark, sf)
    )
    return out.select(
        "request_id", "line_no", "item", F.col("ship_date").cast("string").alias("ship_date"),
        F.col("step").cast("long").alias("step"), "txn_type", "units", F.col("price").cast("double").alias("price"),
        F.col("txn_date").cast("string").alias("txn_date"),
    )


@query(
    "p17_j3_line_validation",
    f"""WITH {LINES_SQL}, {CATALOG_SQL}
    SELECT request_id, line_no, item, CAST(ship_date AS VARCHAR) AS ship_date,
      CASE WHEN quantity <= 0 THEN 'Invalid quantity or missing item name.'
           WHEN item NOT IN (SELECT item FROM catalog) THEN 'Unknown item (not in catalog).' END AS reason FROM lines""",
)
def line_validation(spark, sf):
    out = pred.validate_lines(derive.request_lines(spark, sf), derive.catalog(spark, sf))
    return out.select("request_id", "line_no", "item", F.col("ship_date").cast("string").alias("ship_date"), "reason")


@query(
    "j3_unknown_items",
    f"""WITH {LINES_SQL}, {CATALOG_SQL}
    SELECT item, count(*) AS n_lines FROM lines WHERE item NOT IN (SELECT item FROM catalog) GROUP BY item""",
)
def unknown_items(spark, sf):
    lines = derive.request_lines(spark, sf)
    return lines.join(derive.catalog(spark, sf), "item", "left_anti").groupBy("item").agg(F.count("*").alias("n_lines"))


@query(
    "f1_lead_time",
    f"""WITH {LINES_SQL} SELECT request_id, line_no, item, CAST(ship_date AS VARCHAR) AS ship_date,
    CAST({LEAD.format(q='quantity')} AS BIGINT) AS days,
    CAST(ship_date + CAST({LEAD.format(q='quantity')} AS INTEGER) AS VARCHAR) AS delivery_date FROM lines""",
)
def lead_time(spark, sf):
    q = F.col("quantity")
    return derive.request_lines(spark, sf).select(
        "request_id", "line_no", "item", F.col("ship_date").cast("string").alias("ship_date"),
        fn.lead_days(q).cast("long").alias("days"),
        fn.delivery_date(F.col("ship_date"), q).cast("string").alias("delivery_date"),
    )


@query(
    "f2_f3_price",
    f"""WITH {LINES_SQL}, {CATALOG_SQL},
    p AS (SELECT request_id, line_no, item, ship_date, CAST(unit_price * 100 AS BIGINT) * quantity AS sub,
                 {PCT.format(q='quantity')} AS pct FROM lines JOIN catalog USING (item))
    SELECT request_id, line_no, item, CAST(ship_date AS VARCHAR) AS ship_date, CAST(pct AS DOUBLE) / 100 AS rate,
           CAST(sub AS DOUBLE) / 100 AS subtotal, CAST({half_even('sub * pct')} AS DOUBLE) / 100 AS discount,
           CAST(sub - {half_even('sub * pct')} AS DOUBLE) / 100 AS total FROM p""",
)
def price(spark, sf):
    lines = derive.request_lines(spark, sf).join(derive.catalog(spark, sf), "item")
    rate = fn.discount_rate(F.col("quantity"))
    parts = fn.price_parts(F.col("unit_price"), F.col("quantity"), rate)
    return lines.select(
        "request_id", "line_no", "item", F.col("ship_date").cast("string").alias("ship_date"),
        rate.cast("double").alias("rate"), *[c.cast("double").alias(n) for n, c in parts.items()],
    )


@query(
    "f6_f7_shortage_reorder",
    f"""WITH {LINES_SQL}, {INVENTORY_SQL}, {LEDGER_SQL},
    s AS (SELECT item, CAST(sum({SIGNED}) AS BIGINT) AS stock FROM ledger GROUP BY item)
    SELECT request_id, line_no, item, CAST(ship_date AS VARCHAR) AS ship_date,
      greatest(0, quantity - coalesce(stock, 0)) AS shortage,
      CASE WHEN coalesce(stock, 0) < min_stock_level
           THEN greatest(2 * min_stock_level - coalesce(stock, 0), quantity) END AS reorder
    FROM lines JOIN inventory USING (item) LEFT JOIN s USING (item)""",
)
def shortage_reorder(spark, sf):
    from agentlake.operators.ledger import stock_levels

    lines = derive.request_lines(spark, sf).join(derive.inventory(spark, sf), "item")
    rows = lines.join(stock_levels(derive.ledger(spark, sf)), "item", "left")
    stock = F.coalesce("stock", F.lit(0))
    return rows.select(
        "request_id", "line_no", "item", F.col("ship_date").cast("string").alias("ship_date"),
        fn.shortage(F.col("quantity"), stock).alias("shortage"),
        fn.reorder_quantity(stock, F.col("min_stock_level"), F.col("quantity")).alias("reorder"),
    )


@query(
    "f8_fulfilment_decision",
    f"""WITH {LINES_SQL}, {REQUESTS_SQL},
    d AS (SELECT *, request_date + CAST({LEAD.format(q='quantity')} AS INTEGER) AS dd FROM lines JOIN requests USING (request_id))
    SELECT request_id, line_no, item, CAST(ship_date AS VARCHAR) AS ship_date,
      CASE WHEN requested_by IS NOT NULL AND dd > requested_by THEN 'NOT_FULFILLED' ELSE 'FULFILLED' END AS status,
      CASE WHEN requested_by IS NOT NULL AND dd > requested_by
           THEN 'Requested delivery date cannot be met. Earliest possible: ' || CAST(dd AS VARCHAR) || '.'
           WHEN quantity > 0 THEN 'Supplier lead time required due to shortage.' ELSE '' END AS reason FROM d""",
)
def fulfilment_decision(spark, sf):
    lines = derive.request_lines(spark, sf).join(derive.requests(spark, sf), "request_id")
    delivery = fn.delivery_date(F.col("request_date"), F.col("quantity"))
    by = F.col("requested_by")
    return lines.select(
        "request_id", "line_no", "item", F.col("ship_date").cast("string").alias("ship_date"),
        fn.fulfilment_status(delivery, by).alias("status"),
        fn.fulfilment_reason(delivery, by, F.col("quantity")).alias("reason"),
    )


@query(
    "p1_unpack_metadata",
    """SELECT event_id, coalesce(json_extract_string(props, '$.k'), '') AS k,
       coalesce(json_extract_string(props, '$.missing'), '') AS missing FROM events""",
)
def unpack_metadata(spark, sf):
    from agentlake.core import table

    quoted_props = table(spark, sf, "events").select("event_id", F.translate("props", '"', "'").alias("props"))
    return pred.unpack_metadata(quoted_props, "props", ["k", "missing"]).drop("props")


@query(
    "p2_normalize_date",
    """SELECT event_id, strftime(ts, '%Y-%m-%d') AS day FROM events""",
)
def normalize_date(spark, sf):
    from agentlake.core import table

    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    return table(spark, sf, "events").select("event_id", pred.normalize_date(iso).cast("string").alias("day"))


@query(
    "p3_parse_us_date",
    """SELECT o_orderkey AS request_id, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders
    WHERE o_orderstatus <> 'P' AND year(o_orderdate) >= 2000
    UNION ALL SELECT o_orderkey, strftime(o_orderdate + INTERVAL 100 YEAR, '%Y-%m-%d') FROM orders
    WHERE o_orderstatus <> 'P' AND year(o_orderdate) < 2000""",
)
def parse_us_date(spark, sf):
    from agentlake.core import table

    text = F.when(F.col("o_orderstatus") == "P", "soon").otherwise(F.date_format("o_orderdate", "MM/dd/yy"))
    raw = table(spark, sf, "orders").select(F.col("o_orderkey").alias("request_id"), text.alias("raw"))
    return pred.parse_us_date(raw, "raw", "day").select("request_id", F.col("day").cast("string").alias("day"))


@query(
    "p5_j1_search_quotes",
    """SELECT o_orderkey AS request_id, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS quote_date, p_name AS quote_text, o_orderpriority AS request_text
    FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey) AS rn FROM lineitem) l
    JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
    WHERE rn = 1 AND (contains(lower(p_name), 'red') OR contains(lower(o_orderpriority), 'red'))
      AND (contains(lower(p_name), 'high') OR contains(lower(o_orderpriority), 'high'))
    ORDER BY l_shipdate DESC, o_orderkey LIMIT 5""",
)
def search_quotes(spark, sf):
    from agentlake.core import table
    from agentlake.operators.scans import first_k

    line = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    one = first_k(line, ["l_orderkey"], [F.asc("l_shipdate"), F.asc("l_linenumber"), F.asc("l_partkey")], 1)
    part = table(spark, sf, "part").select("p_partkey", F.col("p_name").alias("quote_text"))
    quotes = one.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("request_id"), F.col("l_shipdate").cast("date").alias("quote_date"), "quote_text"
    )
    requests = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("request_id"), F.col("o_orderpriority").alias("request_text")
    )
    hits = pred.search_quotes(quotes, requests, ["Red", "", "HIGH"], "request_id", ["quote_text", "request_text"], "quote_date")
    return hits.withColumn("quote_date", F.col("quote_date").cast("string"))


@query(
    "p6_catalog_lookup",
    """SELECT c_custkey AS customer, CAST(n_nationkey AS BIGINT) AS nation FROM customer
    JOIN nation ON lower(n_name) = 'nation_' || CAST(c_nationkey AS VARCHAR)""",
)
def catalog_lookup(spark, sf):
    from agentlake.core import table

    nation = table(spark, sf, "nation")
    asked = table(spark, sf, "customer").join(
        nation.select(F.col("n_nationkey").alias("c_nationkey"), F.lower("n_name").alias("asked")), "c_nationkey"
    )
    names = nation.select(F.upper("n_name").alias("name"), F.col("n_nationkey").cast("long").alias("nation"))
    return pred.lookup_ci(asked, "asked", names, "name", "inner").select(F.col("c_custkey").alias("customer"), "nation")
