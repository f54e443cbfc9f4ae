"""Quoting and fulfilment of request lines on a ledger snapshot, gated ledger writes, sequential allocation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agentlake.core import stable
from agentlake.functions import scalars as fn
from agentlake.operators.ledger import as_of_stock
from agentlake.operators.predicates import validate_lines

# what tells the line a ledger row was written for
WRITTEN = ("request_id", "line_no", "item", "ship_date")


def quote_lines(lines: DataFrame, requests: DataFrame, catalog: DataFrame, ledger: DataFrame) -> DataFrame:
    """Per line: validity, stock as of the request date, shortage, price, delivery, status and reason.

    ``lines``: request_id, item, quantity and any other columns; ``requests``: request_id, request_date, intent,
    requested_by. All expressions; two equi-joins (requests, catalog) and the as-of lookup, which weighs items by ``lines``
    as they come in.
    """
    wide = lines.join(requests.select("request_id", "request_date", "intent", "requested_by"), "request_id")
    checked = validate_lines(wide, catalog).withColumnRenamed("reason", "invalid_reason")
    stocked = as_of_stock(checked, ledger, weigh=lines)
    ok = F.col("valid")
    short = fn.shortage(F.col("quantity"), F.col("available"))
    delivery = F.when(F.col("shortage") > 0, fn.delivery_date(F.col("request_date"), F.col("shortage"))).otherwise(
        F.col("request_date")
    )
    parts = fn.price_parts(F.col("unit_price"), F.col("quantity"), fn.discount_rate(F.col("quantity")))
    return (
        stocked.withColumn("shortage", F.when(ok, short))
        .withColumn("delivery_date", F.when(ok, delivery).otherwise(F.col("request_date")))
        .withColumn("total_price", F.when(ok, parts["total"]).otherwise(F.lit(0).cast("decimal(18,2)")))
        .withColumn(
            "status",
            F.when(ok, fn.fulfilment_status(F.col("delivery_date"), F.col("requested_by"))).otherwise("INVALID"),
        )
        .withColumn(
            "reason",
            F.when(ok, fn.fulfilment_reason(F.col("delivery_date"), F.col("requested_by"), F.col("shortage"))).otherwise(
                F.col("invalid_reason")
            ),
        )
        .drop("invalid_reason", "valid")
    )


def overall_status(quoted: DataFrame, requests: DataFrame) -> DataFrame:
    """One row per request with the worst line status and the customer message; no lines means INVALID."""
    per_request = quoted.groupBy("request_id").agg(
        fn.worst_status(F.col("status")).alias("overall_status"),
        F.count("*").alias("n_lines"),
        F.sum("total_price").alias("total_price"),
    )
    out = requests.select("request_id", "intent").join(per_request, "request_id", "left")
    status = F.coalesce("overall_status", F.lit("INVALID"))
    return out.select(
        "request_id",
        "intent",
        status.alias("overall_status"),
        F.coalesce("n_lines", F.lit(0)).alias("n_lines"),
        F.coalesce("total_price", F.lit(0)).alias("total_price"),
        fn.customer_message(status, F.col("intent")).alias("message"),
    )


def place_orders(
    lines: DataFrame, requests: DataFrame, catalog: DataFrame, inventory: DataFrame, ledger: DataFrame
) -> DataFrame:
    """Quote the lines of the orders and emit the ledger rows of the fulfilled ones.

    The quoted lines are read twice (for the status of the request and for its rows), so what is read of them is written
    once. Lines of requests for a quote alone write nothing and decide on no order, so they are left out before all lookups;
    a request id that stands for both keeps all its rows.
    """
    orders = requests.join(requests.filter(F.col("intent") == "ORDER").select("request_id"), "request_id", "left_semi")
    quoted = quote_lines(lines, orders, catalog, ledger)
    read = [c for c in (*WRITTEN, "quantity", "shortage", "delivery_date", "total_price", "status") if c in quoted.columns]
    quoted = stable(quoted.select(*read))
    return ledger_writes(quoted, overall_status(quoted, orders), inventory, ledger)


def ledger_writes(quoted: DataFrame, overall: DataFrame, inventory: DataFrame, ledger: DataFrame) -> DataFrame:
    """Ledger rows of fulfilled orders: shortage purchase, sale, and a reorder where the stock falls under the minimum.

    Only lines of ORDER requests whose overall status is FULFILLED write; items missing from the inventory are skipped.
    Stock after the sale is taken from the snapshot on the delivery date.
    """
    placed = overall.filter((F.col("intent") == "ORDER") & (F.col("overall_status") == "FULFILLED")).select("request_id")
    base = (
        quoted.join(placed, "request_id", "left_semi")
        .drop("unit_price", "available", "status")
        .join(inventory.select("item", "unit_price", "min_stock_level"), "item")
    )
    at_delivery = as_of_stock(base, ledger, day="delivery_date", weigh=quoted)
    after = F.col("available") + F.col("shortage") - F.col("quantity")
    reorder = fn.reorder_quantity(after, F.col("min_stock_level"), F.col("quantity"))

    def entry(kind, units, price, day, step):
        return F.struct(
            F.lit(step).alias("step"), F.lit(kind).alias("txn_type"), units.cast("long").alias("units"),
            price.cast("decimal(18,2)").alias("price"), day.alias("txn_date"),
        )

    cost = lambda units: F.bround(units * F.col("unit_price"), 2)
    rows = F.array(
        F.when(F.col("shortage") > 0, entry("stock_orders", F.col("shortage"), cost(F.col("shortage")), F.col("delivery_date"), 1)),
        entry("sales", F.col("quantity"), F.col("total_price"), F.col("delivery_date"), 2),
        F.when(
            F.col("reorder").isNotNull(),
            entry("stock_orders", F.col("reorder"), cost(F.col("reorder")),
                  fn.delivery_date(F.col("delivery_date"), F.col("reorder")), 3),
        ),
    )
    keep = [c for c in WRITTEN if c in base.columns]
    return (
        at_delivery.withColumn("reorder", reorder)
        .select(*keep, F.explode(F.array_compact(rows)).alias("t"))
        .select(*keep, "t.step", "t.txn_type", "t.units", "t.price", "t.txn_date")
    )
