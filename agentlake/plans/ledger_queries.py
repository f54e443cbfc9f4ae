"""Ledger queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from agentlake.operators import ledger as op
from agentlake.operators import predicates as pred
from agentlake.operators import scans
from agentlake.plans import derive
from agentlake.plans.derive import INVENTORY_SQL, LEDGER_SQL, LINES_SQL, REQUESTS_SQL
from agentlake.plans.registry import query

DAY = "2000-06-30"
SIGNED = "CASE WHEN txn_type = 'stock_orders' THEN units ELSE -units END"
CASH = "CASE WHEN txn_type = 'sales' THEN price ELSE -price END"
SEEDED_SQL = f"""seeded AS (
  SELECT CAST(NULL AS BIGINT) AS txn_id, CAST(NULL AS BIGINT) AS item, 'sales' AS txn_type, CAST(NULL AS BIGINT) AS units,
         CAST({derive.SEED_CASH} AS DECIMAL(18,2)) AS price, DATE '1990-01-01' AS txn_date
  UNION ALL SELECT txn_id, item, txn_type, units, price, txn_date FROM ledger)"""


@query(
    "a1_stock_snapshot",
    f"""WITH {LEDGER_SQL}
    SELECT item, CAST(sum({SIGNED}) AS BIGINT) AS stock FROM ledger WHERE txn_date <= DATE '{DAY}'
    GROUP BY item HAVING sum({SIGNED}) > 0""",
)
def stock_snapshot(spark, sf):
    return op.stock_snapshot(derive.ledger(spark, sf), DAY)


@query(
    "a2_stock_of_item",
    f"""WITH {LEDGER_SQL}
    SELECT CAST(7 AS BIGINT) AS item, CAST(coalesce(sum({SIGNED}), 0) AS BIGINT) AS current_stock
    FROM ledger WHERE txn_date <= DATE '{DAY}' AND item = 7
    UNION ALL
    SELECT CAST(-1 AS BIGINT), CAST(coalesce(sum({SIGNED}), 0) AS BIGINT)
    FROM ledger WHERE txn_date <= DATE '{DAY}' AND item = -1""",
)
def stock_of_item(spark, sf):
    led = derive.ledger(spark, sf)
    out = op.stock_of(led, 7, DAY).unionByName(op.stock_of(led, -1, DAY))
    return out.select(F.col("item").cast("long").alias("item"), "current_stock")


@query(
    "a3_cash_balance",
    f"""WITH {LEDGER_SQL}, {SEEDED_SQL}
    SELECT CAST(coalesce(sum({CASH}), 0) AS DOUBLE) AS cash_balance FROM seeded WHERE txn_date <= DATE '{DAY}'""",
)
def cash_balance(spark, sf):
    led = op.seeded(derive.ledger(spark, sf), derive.SEED_CASH, "1990-01-01")
    return op.cash_balance(led, DAY).select(F.col("cash_balance").cast("double"))


REPORT_SQL = f"""WITH {LEDGER_SQL}, {SEEDED_SQL}, {INVENTORY_SQL},
    cash AS (SELECT sum({CASH}) AS c FROM seeded WHERE txn_date <= DATE '{DAY}'),
    stock AS (SELECT item, sum({SIGNED}) AS s FROM ledger WHERE txn_date <= DATE '{DAY}' GROUP BY item),
    val AS (SELECT sum(coalesce(s, 0) * unit_price) AS v FROM inventory LEFT JOIN stock USING (item)),
    best AS (SELECT coalesce(item, -1) AS item, sum(units) AS u, sum(price) AS r FROM seeded
             WHERE txn_type = 'sales' AND txn_date <= DATE '{DAY}' GROUP BY item ORDER BY r DESC, item LIMIT 5)
    SELECT '{DAY}' AS as_of_date, CAST(c AS DOUBLE) AS cash_balance, CAST(v AS DOUBLE) AS inventory_value,
           CAST(c AS DOUBLE) + CAST(v AS DOUBLE) AS total_assets,
           (SELECT string_agg(CAST(item AS VARCHAR), ',' ORDER BY r DESC, item) FROM best) AS top_items
    FROM cash, val"""


@query("a4_financial_report", REPORT_SQL)
def financial_report(spark, sf):
    led = op.seeded(derive.ledger(spark, sf), derive.SEED_CASH, "1990-01-01")
    rep = op.financial_report(derive.inventory(spark, sf), led, DAY)
    cash, value = F.col("cash_balance").cast("double"), F.col("inventory_value").cast("double")
    ids = F.transform("top_sellers", lambda x: F.coalesce(x["item"], F.lit(-1)).cast("string"))
    return rep.select(
        "as_of_date", cash.alias("cash_balance"), value.alias("inventory_value"),
        (cash + value).alias("total_assets"), F.array_join(ids, ",").alias("top_items"),
    )


@query(
    "a5_top_sellers",
    f"""WITH {LEDGER_SQL}, {SEEDED_SQL}
    SELECT item, CAST(sum(units) AS BIGINT) AS total_units, CAST(sum(price) AS DOUBLE) AS total_revenue
    FROM seeded WHERE txn_type = 'sales' AND txn_date <= DATE '{DAY}'
    GROUP BY item ORDER BY sum(price) DESC, item NULLS LAST LIMIT 5""",
)
def top_sellers(spark, sf):
    led = op.seeded(derive.ledger(spark, sf), derive.SEED_CASH, "1990-01-01")
    return op.top_sellers(led, DAY).withColumn("total_revenue", F.col("total_revenue").cast("double"))


@query(
    "j2_inventory_value",
    f"""WITH {LEDGER_SQL}, {INVENTORY_SQL},
    stock AS (SELECT item, sum({SIGNED}) AS s FROM ledger WHERE txn_date <= DATE '{DAY}' GROUP BY item)
    SELECT item, item_name, CAST(coalesce(s, 0) AS BIGINT) AS stock, CAST(unit_price AS DOUBLE) AS unit_price,
           CAST(coalesce(s, 0) * unit_price AS DOUBLE) AS value FROM inventory LEFT JOIN stock USING (item)""",
)
def inventory_value(spark, sf):
    out = op.inventory_value(derive.inventory(spark, sf), derive.ledger(spark, sf), DAY)
    return out.withColumns({c: F.col(c).cast("double") for c in ("unit_price", "value")})


@query(
    "j4_as_of_stock",
    f"""WITH {LEDGER_SQL}, {LINES_SQL}, {REQUESTS_SQL},
    daily AS (SELECT item, txn_date, sum({SIGNED}) AS net FROM ledger GROUP BY 1, 2),
    cum AS (SELECT item, txn_date, sum(net) OVER (PARTITION BY item ORDER BY txn_date) AS stock FROM daily),
    p AS (SELECT request_id, line_no, item, ship_date, request_date FROM lines JOIN requests USING (request_id))
    SELECT p.request_id, p.line_no, p.item, CAST(p.ship_date AS VARCHAR) AS ship_date,
           CAST(coalesce(c.stock, 0) AS BIGINT) AS available
    FROM p ASOF LEFT JOIN cum c ON p.item = c.item AND p.request_date >= c.txn_date""",
)
def as_of_stock(spark, sf):
    lines = derive.request_lines(spark, sf).join(derive.requests(spark, sf).select("request_id", "request_date"), "request_id")
    out = op.as_of_stock(lines, derive.ledger(spark, sf))
    return out.select("request_id", "line_no", "item", F.col("ship_date").cast("string").alias("ship_date"), "available")


@query(
    "w1_running_stock",
    f"""WITH {LEDGER_SQL}
    SELECT txn_id, item, CAST(txn_date AS VARCHAR) AS txn_date,
           CAST(sum({SIGNED}) OVER (PARTITION BY item ORDER BY txn_date, txn_id
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running_stock FROM ledger""",
)
def running_stock(spark, sf):
    out = op.running_stock(derive.ledger(spark, sf))
    return out.select("txn_id", "item", F.col("txn_date").cast("string").alias("txn_date"), "running_stock")


@query(
    "w1_running_cash",
    f"""WITH {LEDGER_SQL}, d AS (SELECT txn_date, sum({CASH}) AS net FROM ledger GROUP BY 1)
    SELECT CAST(txn_date AS VARCHAR) AS txn_date, CAST(net AS DOUBLE) AS net_cash,
           CAST(sum(net) OVER (ORDER BY txn_date) AS DOUBLE) AS cash_balance FROM d""",
)
def running_cash(spark, sf):
    out = op.running_cash(derive.ledger(spark, sf))
    return out.select(
        F.col("txn_date").cast("string").alias("txn_date"),
        F.col("net_cash").cast("double").alias("net_cash"), F.col("cash_balance").cast("double").alias("cash_balance"),
    )


@query(
    "u1_seed_union",
    f"""WITH {LEDGER_SQL}, {SEEDED_SQL}
    SELECT txn_type, count(*) AS n, CAST(count(item) AS BIGINT) AS with_item, CAST(sum(price) AS DOUBLE) AS price
    FROM seeded GROUP BY txn_type""",
)
def seed_union(spark, sf):
    led = op.seeded(derive.ledger(spark, sf), derive.SEED_CASH, "1990-01-01")
    return led.groupBy("txn_type").agg(
        F.count("*").alias("n"), F.count("item").alias("with_item"), F.sum("price").cast("double").alias("price")
    )


@query(
    "p4_as_of_filter",
    f"""WITH {LEDGER_SQL} SELECT CAST(txn_date AS VARCHAR) AS txn_date, count(*) AS n FROM ledger
    WHERE txn_date <= DATE '{DAY}' GROUP BY 1""",
)
def as_of_filter(spark, sf):
    return (
        op.as_of(derive.ledger(spark, sf), DAY)
        .groupBy(F.col("txn_date").cast("string").alias("txn_date"))
        .agg(F.count("*").alias("n"))
    )


@query(
    "s2_row_ids",
    """SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS row_id, o_orderkey AS request_id FROM orders""",
)
def row_ids(spark, sf):
    req = derive.requests(spark, sf)
    out = scans.numbered(req, [], ["request_date", "request_id"], F.col("request_date"), "row_id")
    return out.select("row_id", "request_id")


@query(
    "s6_ledger_append_rejects",
    """SELECT event_type AS txn_type, count(*) AS n, event_type IN ('click', 'view') AS accepted
    FROM (SELECT CASE event_type WHEN 'click' THEN 'sales' WHEN 'view' THEN 'stock_orders' ELSE event_type END AS t, event_type
          FROM events) GROUP BY event_type""",
)
def ledger_rejects(spark, sf):
    from agentlake.core import table

    kind = F.col("event_type")
    typed = table(spark, sf, "events").select(
        kind,
        F.when(kind == "click", "sales").when(kind == "view", "stock_orders").otherwise(kind).alias("txn_type"),
    )
    good, bad = op.split_valid(typed)
    both = good.select("event_type", F.lit(True).alias("accepted")).unionByName(
        bad.select("event_type", F.lit(False).alias("accepted"))
    )
    return both.groupBy(F.col("event_type").alias("txn_type"), "accepted").agg(F.count("*").alias("n"))


@query(
    "s10_count_and_peek",
    """SELECT doc_id, n_chars, (SELECT count(*) FROM documents) AS n FROM documents ORDER BY doc_id LIMIT 5""",
)
def count_and_peek(spark, sf):
    from agentlake.sources.collections import with_count, peek
    from agentlake.core import table

    return with_count(peek(table(spark, sf, "documents").select("doc_id", "n_chars"), 5, "doc_id"),
                      table(spark, sf, "documents"))


HASH = "CAST('0x' || substr(md5(p_partkey || ':{seed}'), 1, 13) AS BIGINT)"


@query(
    "s12_exact_sample",
    f"""WITH h AS (SELECT p_partkey AS item, p_type AS category, {HASH.format(seed=137)} AS h, 200 + {HASH.format(seed=138)} % 600 AS current_stock,
      50 + {HASH.format(seed=139)} % 100 AS min_stock_level FROM part),
    r AS (SELECT *, row_number() OVER (ORDER BY h, item) AS rn, count(*) OVER () AS n FROM h)
    SELECT item, category, current_stock, min_stock_level FROM r WHERE rn <= floor(n * 0.4::DOUBLE)""",
)
def exact_sample(spark, sf):
    from agentlake.sources.sampling import sample_inventory
    from agentlake.core import table

    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("item"), F.col("p_type").alias("category"))
    return sample_inventory(parts, "item", fraction=0.4, seed=137)


@query(
    "k1_top_bottom",
    """(SELECT 'top' AS side, p_partkey AS item, p_retailprice AS score FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 10)
    UNION ALL
    (SELECT 'bottom', p_partkey, p_retailprice FROM part ORDER BY p_retailprice, p_partkey LIMIT 10)""",
)
def top_bottom(spark, sf):
    from agentlake.core import table

    scored = table(spark, sf, "part").select(F.col("p_partkey").alias("item"), F.col("p_retailprice").alias("score"))
    top = pred.top_n(scored, "score", "item", 10)
    bottom = pred.top_n(scored, "score", "item", 10, ascending=True)
    return top.select(F.lit("top").alias("side"), "item", "score").unionByName(
        bottom.select(F.lit("bottom").alias("side"), "item", "score")
    )


@query(
    "k2_newest_first",
    """SELECT o_orderkey AS request_id, strftime(o_orderdate, '%Y-%m-%d') AS request_date FROM orders
    ORDER BY o_orderdate DESC, o_orderkey LIMIT 5""",
)
def newest_first(spark, sf):
    req = derive.requests(spark, sf).select("request_id", "request_date")
    return pred.top_n(req, "request_date", "request_id", 5).withColumn("request_date", F.col("request_date").cast("string"))


@query(
    "k3_missing_date_last",
    f"""WITH {REQUESTS_SQL}
    SELECT customer, request_id, CAST(requested_by AS VARCHAR) AS requested_by,
           row_number() OVER (PARTITION BY customer ORDER BY requested_by NULLS LAST, request_id) AS place FROM requests""",
)
def missing_date_last(spark, sf):
    req = derive.requests(spark, sf)
    far = F.coalesce(F.col("requested_by"), F.lit("9999-12-31").cast("date"))
    out = scans.numbered(req, ["customer"], [F.asc_nulls_last("requested_by"), "request_id"], far, "place")
    return out.select("customer", "request_id", F.col("requested_by").cast("string").alias("requested_by"), "place")


@query(
    "k5_requests_in_date_order",
    """SELECT CAST(o_orderdate AS DATE)::VARCHAR AS request_date, o_orderkey AS request_id FROM orders""",
)
def requests_in_date_order(spark, sf):
    req = derive.requests(spark, sf).orderBy("request_date", "request_id")
    return req.select(F.col("request_date").cast("string").alias("request_date"), "request_id")
