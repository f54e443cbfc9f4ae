"""Queues, bookings, task order, supply grants, production recipes, stock updates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agentlake.functions import scalars as fn
from agentlake.operators.scans import first_k, id_slice, lookback, numbered, paged_lists, running

_WIDE = 1 << 40


def _slice(major: Column, seq: str) -> Column:
    """Order-preserving slice for the order (small integer ``major``, integer ``seq``)."""
    return major.cast("long") * _WIDE + id_slice(seq)


def queue_load(queue: DataFrame, keys: list[str]) -> DataFrame:
    """Size, volume, days of work (volume / 10, at least 1) and the share of rush and emergency orders."""
    pressing = F.col("priority") > fn.NORMAL
    return queue.groupBy(*keys).agg(
        F.count("*").alias("n_orders"),
        F.sum("quantity").alias("volume"),
        fn.queue_days(F.sum("quantity")).alias("days"),
        F.count_if(pressing).alias("n_pressing"),
        F.coalesce(F.sum(F.when(pressing, F.col("quantity"))), F.lit(0)).alias("pressing_volume"),
    )


def reprioritize(queue: DataFrame, updates: DataFrame) -> DataFrame:
    """Apply the last valid priority per order and give the changed orders a new ready date.

    ``updates``: order_id, seq, priority; priorities outside 1..3 are refused and orders not in the queue ignored.
    The queue volume is a scalar subquery.
    """
    valid = updates.filter(F.col("priority").isin(fn.NORMAL, fn.RUSH, fn.EMERGENCY))
    last = valid.groupBy("order_id").agg(F.max_by("priority", "seq").alias("new_priority"))
    volume = queue.agg(F.coalesce(F.sum("quantity"), F.lit(0)).alias("volume"))
    changed = queue.join(last, "order_id").withColumn("volume", volume.scalar())
    days = fn.eta_days(F.col("volume"), F.col("new_priority"))
    return changed.select(
        "order_id", F.col("priority").alias("old_priority"), "new_priority",
        F.date_add(F.col("order_date"), days.cast("int")).alias("ready_date"),
    )


def first_come(bookings: DataFrame, capacity: DataFrame, service: str = "service", seq: str = "seq") -> DataFrame:
    """Accept the first ``slots`` bookings per service in arrival order; null ``slots`` means no limit."""
    placed = numbered(bookings, [service], [seq], id_slice(seq), "place")
    limits = capacity.select(service, "slots", F.lit(True).alias("__known"))
    open_slot = F.col("slots").isNull() | (F.col("place") <= F.col("slots"))
    out = placed.join(limits, service, "left")
    return out.withColumn("accepted", F.coalesce(F.col("__known") & open_slot, F.lit(False))).drop("__known", "slots")


def one_per_slot(bookings: DataFrame, slot: list[str], seq: str) -> DataFrame:
    """The first booking of each slot wins."""
    return first_k(bookings, slot, [F.asc(seq)], 1).drop("rank")


def bookings_by_day(bookings: DataFrame, day: str, slot: str, customer: str, seq: str) -> DataFrame:
    """Per day a map slot -> customer; one booking per slot, so the map is bounded by the slots of a day."""
    won = one_per_slot(bookings, [day, slot], seq)
    return won.groupBy(day).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct(slot, customer)))).alias("bookings")
    )


def booking_pages(bookings: DataFrame, service: str, seq: str, text: Column, page_rows: int = 1000) -> DataFrame:
    """Bookings of a service as numbered pages of joined text; a page is bounded, a service has as many as it needs."""
    pages = paged_lists(bookings, [service], [seq], id_slice(seq), text, page_rows)
    return pages.select(service, "page", "n", F.array_join("items", "; ").alias("listing"))


def sequence_ids(df: DataFrame, seq: str, prefix: str = "ORD", width: int = 4, out: str = "order_id") -> DataFrame:
    """``ORD-0001`` style ids in the order of an integer key, without a single-task sort."""
    n = numbered(df, [], [seq], id_slice(seq), "__n")
    return n.withColumn(out, F.format_string(f"{prefix}-%0{width}d", F.col("__n"))).drop("__n")


def order_deterministic(tasks: DataFrame, batch: str = "batch", seq: str = "seq") -> DataFrame:
    """While a task is urgent or has priority >= 8 take the highest priority, then the least complex.

    Closed form: with P the place by (priority desc, seq) and L the last such place that is urgent or >= 8,
    places up to L keep P; the others follow by (complexity, seq).
    """
    by_priority = numbered(tasks, [batch], [F.desc("priority"), F.asc(seq)], _slice(-F.col("priority"), seq), "__p")
    pressing = (F.col("deadline") == "urgent") | (F.col("priority") >= 8)
    last = by_priority.groupBy(batch).agg(F.coalesce(F.max(F.when(pressing, F.col("__p"))), F.lit(0)).alias("__l"))
    both = by_priority.join(last, batch)
    head = both.filter(F.col("__p") <= F.col("__l")).withColumn("place", F.col("__p"))
    rest = numbered(
        both.filter(F.col("__p") > F.col("__l")), [batch], [F.asc("complexity"), F.asc(seq)],
        _slice(F.col("complexity"), seq), "__c",
    )
    tail = rest.withColumn("place", F.col("__l") + F.col("__c")).drop("__c")
    return head.unionByName(tail).drop("__p", "__l")


def order_by_size(tasks: DataFrame, batch: str = "batch", seq: str = "seq", last: int = 3) -> DataFrame:
    """Least complex first while more than ``last`` tasks are left; the ``last`` ones by priority."""
    by_size = numbered(tasks, [batch], [F.asc("complexity"), F.asc(seq)], _slice(F.col("complexity"), seq), "__c")
    counts = tasks.groupBy(batch).agg(F.count("*").alias("__n"))
    both = by_size.join(counts, batch)
    cut = F.col("__n") - last
    head = both.filter(F.col("__c") <= cut).withColumn("place", F.col("__c"))
    w = Window.partitionBy(batch).orderBy(F.desc("priority"), F.asc(seq))  # at most ``last`` rows per batch
    tail = both.filter(F.col("__c") > cut).withColumn("place", F.greatest(cut, F.lit(0)) + F.row_number().over(w))
    return head.unionByName(tail).drop("__c", "__n")


def order_fixed(tasks: DataFrame, batch: str, name: str, slice_by: Column) -> DataFrame:
    """Tasks of complexity under 5 first, by name in both parts; ``slice_by`` must follow the name order."""
    hard = (F.col("complexity") >= 5).cast("int")
    return numbered(tasks, [batch], [hard, F.asc(name)], hard.cast("long") * _WIDE + slice_by, "place")


def supply_grants(wants: DataFrame, pool: list[str], seq: str, supply: int, most: int = 5) -> DataFrame:
    """Grant min(clamp(want, 0, most), what is left) in arrival order; partial grants are allowed."""
    asked = wants.withColumn("__w", F.least(F.greatest(F.col("want"), F.lit(0)), F.lit(most)).cast("long"))
    prior = running(asked, pool, [seq], id_slice(seq, 4096), {"__prior": F.col("__w")}, inclusive=False)
    left = F.lit(supply) - F.col("__prior")
    return prior.withColumn("granted", F.greatest(F.lit(0).cast("long"), F.least(F.col("__w"), left))).drop("__w", "__prior")


def recent_history(entries: DataFrame, subject: str, seq: str, amount: str, flag: str, rows: int = 3) -> DataFrame:
    """Sum of the last ``rows`` entries per subject and whether the flag was ever set so far."""
    seen = running(entries, [subject], [seq], id_slice(seq, 4096), {"__seen": F.col(flag).cast("long")})
    out = lookback(seen, [subject], [seq], id_slice(seq, 4096), {"recent_sum": ("sum", amount)}, rows - 1, seq="entry_no")
    return out.withColumn("ever", F.col("__seen") > 0).drop("__seen")


def decisions_per_subject(entries: DataFrame, subject: str, amount: str, flag: str) -> DataFrame:
    return entries.groupBy(subject).agg(
        F.count("*").alias("n"), F.sum(amount).alias("total"), F.count_if(F.col(flag)).alias("n_flagged")
    )


def purchase_summary(purchases: DataFrame) -> DataFrame:
    """Per user: spend, count, units, and the most-bought item (units, then first bought, then item id)."""
    per_item = purchases.groupBy("user", "item").agg(
        F.sum("cost").alias("cost"), F.count("*").alias("n"), F.sum("units").alias("units"), F.min("seq").alias("first")
    )
    best = F.max_by(F.struct("item", "units"), F.struct("units", -F.col("first"), -F.col("item")))
    return (
        per_item.groupBy("user")
        .agg(F.sum("cost").alias("spent"), F.sum("n").alias("n_purchases"), F.sum("units").alias("units"), best.alias("b"))
        .select("user", "spent", "n_purchases", F.col("units"), F.col("b.item").alias("top_item"), F.col("b.units").alias("top_units"))
    )


def producible(recipes: DataFrame, stock: DataFrame) -> DataFrame:
    """Largest whole quantity of each product that the ingredient stock allows; 0 with a missing ingredient.

    ``recipes``: product, ingredients map<ingredient, whole amount>; ``stock``: ingredient, amount.
    """
    need = recipes.select("product", F.explode("ingredients").alias("ingredient", "need"))
    have = need.join(stock, "ingredient", "left")
    return have.groupBy("product").agg(
        F.min(F.floor(F.greatest(F.coalesce("amount", F.lit(0)), F.lit(0)) / F.col("need"))).alias("most")
    )


def sufficiency(orders: DataFrame, recipes: DataFrame, stock: DataFrame) -> DataFrame:
    """Flag per order: recipe known and every ingredient in stock for its quantity.

    ``stock >= need * quantity`` for all ingredients is ``quantity <= min(floor(stock / need))``, so the orders join
    one number per product in place of one row per ingredient.
    """
    out = orders.join(producible(recipes, stock), "product", "left")
    return out.withColumn("sufficient", F.coalesce(F.col("quantity") <= F.col("most"), F.lit(False))).drop("most")


def stock_after_updates(stock: DataFrame, updates: DataFrame) -> DataFrame:
    """Replay set and add updates: last set per item plus the sum of later deltas.

    ``updates``: item, seq, kind {set, add}, amount. Returns old and new amount of known items.
    """
    sets = updates.filter(F.col("kind") == "set").groupBy("item").agg(
        F.max("seq").alias("__s"), F.max_by("amount", "seq").alias("__base")
    )
    adds = updates.filter(F.col("kind") == "add").select("item", "seq", "amount")
    later = (
        adds.join(sets.select("item", "__s"), "item", "left")
        .filter(F.col("__s").isNull() | (F.col("seq") > F.col("__s")))
        .groupBy("item").agg(F.sum("amount").alias("__delta"))
    )
    out = stock.join(sets, "item", "left").join(later, "item", "left")
    new = F.coalesce("__base", "amount") + F.coalesce("__delta", F.lit(0))
    return out.select("item", F.col("amount").alias("old_amount"), new.alias("new_amount"))


def rejected_updates(stock: DataFrame, updates: DataFrame) -> DataFrame:
    """Updates of items that the stock does not have, a null item among them; they change nothing."""
    return updates.join(stock, "item", "left_anti")
