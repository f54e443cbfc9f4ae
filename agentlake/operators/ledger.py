"""Transaction ledger: stock, cash, reports, as-of lookups, running balances.

Ledger columns: ``txn_id long, item, txn_type string, units long, price decimal, txn_date date``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agentlake.operators.scans import HOT_ROWS, is_heavy, running

# fixed values: the two accepted transaction types
TXN_TYPES = ("stock_orders", "sales")


def signed_units() -> Column:
    t = F.col("txn_type")
    return F.when(t == "stock_orders", F.col("units")).when(t == "sales", -F.col("units")).otherwise(F.lit(0))


def signed_cash() -> Column:
    t = F.col("txn_type")
    return F.when(t == "sales", F.col("price")).when(t == "stock_orders", -F.col("price"))


def as_of(ledger: DataFrame, day: str | Column) -> DataFrame:
    """Rows up to and including ``day``; reaches the Parquet scan as a pushed filter."""
    return ledger.filter(F.col("txn_date") <= (F.lit(day).cast("date") if isinstance(day, str) else day))


def stock_levels(ledger: DataFrame) -> DataFrame:
    return ledger.filter(F.col("item").isNotNull()).groupBy("item").agg(F.sum(signed_units()).alias("stock"))


def stock_snapshot(ledger: DataFrame, day: str | Column) -> DataFrame:
    """Stock per item on ``day``; only items with a positive stock."""
    return stock_levels(as_of(ledger, day)).filter(F.col("stock") > 0)


def stock_of(ledger: DataFrame, item, day: str | Column) -> DataFrame:
    """Stock of one item: always one row, 0 where the item is unknown."""
    mine = as_of(ledger, day).filter(F.col("item") == F.lit(item))
    return mine.agg(F.coalesce(F.sum(signed_units()), F.lit(0)).cast("long").alias("current_stock")).select(
        F.lit(item).alias("item"), "current_stock"
    )


def cash_balance(ledger: DataFrame, day: str | Column) -> DataFrame:
    total = F.coalesce(F.sum(signed_cash()), F.lit(0))
    return as_of(ledger, day).agg(total.cast("decimal(38,2)").alias("cash_balance"))


def inventory_value(inventory: DataFrame, ledger: DataFrame, day: str | Column) -> DataFrame:
    """Every inventory item with its stock and value; one aggregate and one join in place of a query per item."""
    stock = stock_levels(as_of(ledger, day))
    held = F.coalesce(F.col("stock"), F.lit(0))
    return inventory.join(stock, "item", "left").select(
        "item", "item_name", held.alias("stock"), "unit_price", (held * F.col("unit_price")).alias("value")
    )


def top_sellers(ledger: DataFrame, day: str | Column, n: int = 5, include_null_item: bool = True) -> DataFrame:
    """Best items by revenue; the item-less cash seed counts as a group unless told otherwise."""
    sold = as_of(ledger, day).filter(F.col("txn_type") == "sales")
    if not include_null_item:
        sold = sold.filter(F.col("item").isNotNull())
    return (
        sold.groupBy("item")
        .agg(F.sum("units").alias("total_units"), F.sum("price").alias("total_revenue"))
        .orderBy(F.desc("total_revenue"), F.asc_nulls_last("item"))
        .limit(n)
    )


def financial_report(inventory: DataFrame, ledger: DataFrame, day: str, top: int = 5) -> DataFrame:
    """Cash, inventory value, total assets and the top sellers as one row.

    The item breakdown grows with the inventory, so it stays a table of its own (``inventory_value``).
    """
    cash = cash_balance(ledger, day)
    value = inventory_value(inventory, ledger, day).agg(F.coalesce(F.sum("value"), F.lit(0)).alias("inventory_value"))
    best = top_sellers(ledger, day, top).agg(
        F.expr(
            "array_sort(collect_list(struct(total_revenue, item, total_units)),"
            " (a, b) -> CASE WHEN a.total_revenue > b.total_revenue THEN -1"
            " WHEN a.total_revenue < b.total_revenue THEN 1 WHEN a.item < b.item THEN -1"
            " WHEN a.item > b.item THEN 1 ELSE 0 END)"
        ).alias("top_sellers")
    )
    money = lambda c: F.col(c).cast("decimal(38,2)")
    totals = cash.select(F.col("cash_balance"), value.select(money("inventory_value")).scalar().alias("inventory_value"), best.scalar().alias("top_sellers"))
    return totals.select(
        F.lit(day).alias("as_of_date"),
        "cash_balance",
        "inventory_value",
        (F.col("cash_balance") + F.col("inventory_value")).alias("total_assets"),
        "top_sellers",
    )


def as_of_stock(
    lines: DataFrame, ledger: DataFrame, item: str = "item", day: str = "request_date", weigh: DataFrame | None = None, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Stock of each line's item on the line's date (same-day rows included).

    Lines and ledger rows are moved once, to their item, where one running sum in the order of the days passes the ledger rows
    of a day before its lines. An item with more than ``hot_rows`` rows is not gathered like this (``_hot_as_of_stock``).
    ``weigh`` has the rows by which the lines of an item are counted; give it where ``lines`` are costly to compute, such as the
    lines before a join that adds none.
    """
    changes = ledger.filter(F.col("item").isNotNull()).select(
        F.col("item").alias("__item"), F.col("txn_date").alias("__day"), signed_units().alias("__net")
    )
    counted = (lines if weigh is None else weigh).select(F.col(item).alias("__item"))
    heavy = is_heavy(changes.select("__item").unionByName(counted), ["__item"], hot_rows)
    marked = lines.withColumns({"__item": F.col(item), "__day": F.col(day), "__net": F.lit(0).cast("long"), "__line": F.lit(True)})
    if heavy is None:
        return _merged_stock(marked, changes, lines.columns)
    hot = _hot_as_of_stock(marked.filter(heavy).select(*lines.columns), changes.filter(heavy), item, day)
    return _merged_stock(marked.filter(~heavy), changes.filter(~heavy), lines.columns).unionByName(hot)


def _merged_stock(marked: DataFrame, changes: DataFrame, columns: list[str]) -> DataFrame:
    both = marked.unionByName(changes.withColumn("__line", F.lit(False)), allowMissingColumns=True)
    w = Window.partitionBy("__item").orderBy("__day", "__line").rowsBetween(Window.unboundedPreceding, 0)
    stock = both.withColumn("available", F.coalesce(F.sum("__net").over(w), F.lit(0)))
    return stock.filter("__line").select(*columns, "available")


def _hot_as_of_stock(lines: DataFrame, changes: DataFrame, item: str, day: str) -> DataFrame:
    """The same for items with very many rows: the rows and zero-change probe rows are summed per (item, day) in one map-side
    combined aggregate, so the window sees one row per day, however many rows the item has. No range join is needed."""
    probes = lines.select(F.col(item).alias("__item"), F.col(day).alias("__day"), F.lit(0).cast("long").alias("__net"))
    per_day = changes.unionByName(probes).groupBy("__item", "__day").agg(F.sum("__net").alias("__net"))
    w = Window.partitionBy("__item").orderBy("__day").rowsBetween(Window.unboundedPreceding, 0)
    stock = per_day.select("__item", "__day", F.sum("__net").over(w).alias("available"))
    hit = lines[item].eqNullSafe(stock["__item"]) & lines[day].eqNullSafe(stock["__day"])
    return lines.join(stock, hit, "left").drop("__item", "__day").withColumn(
        "available", F.coalesce("available", F.lit(0))
    )


def running_stock(ledger: DataFrame) -> DataFrame:
    """Stock of the item after each ledger row, in (date, id) order."""
    rows = ledger.filter(F.col("item").isNotNull())
    return running(rows, ["item"], ["txn_date", "txn_id"], F.col("txn_date"), {"running_stock": signed_units()})


def running_cash(ledger: DataFrame) -> DataFrame:
    """Cash at the end of each day: rows are reduced to one per day before the only global window."""
    daily = ledger.groupBy("txn_date").agg(F.coalesce(F.sum(signed_cash()), F.lit(0)).alias("net_cash"))
    w = Window.orderBy("txn_date").rowsBetween(Window.unboundedPreceding, 0)
    return daily.select("txn_date", "net_cash", F.sum("net_cash").over(w).alias("cash_balance"))


def seeded(ledger: DataFrame, amount, day: str) -> DataFrame:
    """Opening cash as a ``sales`` row without an item, in front of the stock rows."""
    seed = ledger.sparkSession.range(1).select(
        F.lit("sales").alias("txn_type"), F.lit(amount).cast("decimal(18,2)").alias("price"),
        F.lit(day).cast("date").alias("txn_date"),
    )
    return seed.unionByName(ledger, allowMissingColumns=True).select(*ledger.columns)


def split_valid(transactions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): rejected rows carry the reason."""
    known = F.coalesce(F.col("txn_type").isin(*TXN_TYPES), F.lit(False))
    bad = transactions.filter(~known).withColumn(
        "reason", F.concat(F.lit("unknown transaction type: "), F.coalesce(F.col("txn_type"), F.lit("null")))
    )
    return transactions.filter(known), bad
