"""Sequential allocation: every accepted order lowers the stock the next one of its key sees.

Light keys are folded in one task each, many keys per task. A key with more lines than ``hot_lines`` is never gathered:
its orders are settled in rounds over the whole cluster. A round drops the orders that ask for more than is left (stock
only falls, so they can never succeed) and settles a phase at once. An order that asks for no more than half of each
item's stock is small: until an item has lost half, every small order fits, so running sums of the small orders alone say
what is left at any order in between, and any other order before the end of the phase is rejected there, however many they
are. The phase ends with the first of those that fits, or with the small order that takes an item to its half. Behind it,
the next ``hot_lines`` lines are folded in one task. So rounds depend on how often stocks halve, not on rejections, and
are never more than the lines of a key divided by ``hot_lines``. Each round adds what it settled to a table in the shared
folder. The result equals the one-by-one loop.
"""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from agentlake.core import shared_dir, stable
from agentlake.operators.scans import id_slice, running

HOT_LINES = 1_000_000


def _fold(lines: DataFrame, stock: DataFrame, key: str, seq: str, schema: str) -> DataFrame:
    def settle(pdf: pd.DataFrame, have: pd.DataFrame) -> pd.DataFrame:
        left = dict(zip(have["item"].tolist(), have["amount"].tolist()))
        rows = pdf.sort_values([seq, "item"], kind="stable")
        orders, out, need, sound = rows[seq].tolist(), [], {}, True
        items, quantities, good = rows["item"].tolist(), rows["quantity"].tolist(), rows["sound"].tolist()
        for i, order in enumerate(orders):
            need[items[i]], sound = quantities[i], sound and good[i]
            if i + 1 == len(orders) or orders[i + 1] != order:
                out.append(sound and all(left.get(x, 0) >= q for x, q in need.items()))
                if out[-1]:
                    left.update({x: left.get(x, 0) - q for x, q in need.items()})
                need, sound = {}, True
        each = rows[[key, seq]].drop_duplicates(seq)
        return each.assign(accepted=out)

    fresh = stock.select(*[F.col(c).alias(c) for c in stock.columns])  # both sides may come from one table
    return lines.groupBy(key).cogroup(fresh.groupBy(key)).applyInPandas(settle, schema)


def _settle(pending: DataFrame, left: DataFrame, key: str, seq: str, block: int, hot_rows: int, fold_lines: int):
    """One round: (settled orders, first order not settled per key, lines to be folded next)."""
    with_left = pending.join(left, [key, "item"], "left").withColumn("amount", F.coalesce("amount", F.lit(0)))
    each = with_left.groupBy(key, seq).agg(
        F.bool_and(F.col("sound") & (F.col("quantity") <= F.col("amount"))).alias("__ok"),
        F.bool_and(F.coalesce(F.col("quantity") <= F.try_subtract(F.col("amount"), F.col("quantity")), F.lit(False))).alias("__small"),
    )
    no = each.filter("NOT __ok").select(key, seq, F.lit(False).alias("accepted"))
    live = stable(with_left.join(each.filter("__ok").select(key, seq, "__small"), [key, seq]))
    # small orders use up their sums; before an order of another kind only those count
    use = F.when(F.col("__small"), F.col("quantity")).otherwise(F.lit(0)).cast(live.schema["quantity"].dataType)
    sums = running(live, [key, "item"], [seq], id_slice(seq, block), {"__sum": use}, hot_rows=hot_rows)
    # the last order of the phase: a small one that takes half of an item's stock, or the first other one that fits
    order = sums.groupBy(key, seq, "__small").agg(
        F.bool_or(F.col("__sum") >= F.col("amount") - F.col("__sum")).alias("__half"),
        F.bool_and(F.col("quantity") <= F.col("amount") - F.col("__sum")).alias("__fits"),
    )
    last = stable(order.filter("(__small AND __half) OR (NOT __small AND __fits)").groupBy(key).agg(F.min(seq).alias("__last")))
    ended = live.join(last, key, "left")
    inside = F.col("__last").isNull() | (F.col(seq) <= F.col("__last"))
    done = ended.filter(inside).select(key, seq, "item", "quantity", (F.col("__small") | F.col(seq).eqNullSafe(F.col("__last"))).alias("accepted"))
    after = ended.filter(~inside).select(key, seq, "item", "quantity", "sound")
    at = running(after, [key], [seq, "item"], id_slice(seq, block), {"__n": F.lit(1).cast("long")}, hot_rows=hot_rows)
    beyond = at.filter(F.col("__n") > fold_lines).groupBy(key).agg(F.min(seq).alias("__cut"))
    return no, stable(done), stable(after.join(beyond, key, "left"))


def _rounds(lines: DataFrame, stock: DataFrame, key: str, seq: str, block: int, hot_rows: int, fold_lines: int, rounds: list | None = None) -> DataFrame:
    """Orders of keys that are too large for a task; ``rounds``, if given, takes the number of lines each round began with."""
    spark = lines.sparkSession
    left, pending = stable(stock), stable(lines)
    settled = f"{shared_dir(spark)}/settled-{uuid.uuid4().hex}"
    kinds = lines.select(key, seq, F.lit(True).alias("accepted")).schema
    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kinds.fields)
    spark.createDataFrame([], kinds).write.parquet(settled)

    def taken_from(left: DataFrame, accepted: DataFrame) -> DataFrame:
        used = accepted.groupBy(key, "item").agg(F.sum("quantity").alias("__used"))
        now = (F.col("amount") - F.coalesce("__used", F.lit(0))).cast(left.schema["amount"].dataType)
        return stable(left.join(used, [key, "item"], "left").select(key, "item", now.alias("amount")))

    while not pending.isEmpty():
        if rounds is not None:
            rounds.append(pending.count())
        no, done, after = _settle(pending, left, key, seq, block, hot_rows, fold_lines)
        no.unionByName(done.select(key, seq, "accepted").distinct()).write.mode("append").parquet(settled)
        left = taken_from(left, done.filter("accepted"))
        near = F.col("__cut").isNull() | (F.col(seq) < F.col("__cut"))
        fold = after.filter(near).select(key, seq, "item", "quantity", "sound")
        mine = left.join(fold.select(key, "item").distinct(), [key, "item"], "left_semi")
        folded = stable(_fold(fold, mine, key, seq, kind))
        folded.write.mode("append").parquet(settled)
        left = taken_from(left, fold.join(folded.filter("accepted").select(key, seq), [key, seq], "left_semi"))
        pending = stable(after.filter(~near).select(key, seq, "item", "quantity", "sound"))
    return spark.read.schema(kinds).parquet(settled)


def allocate(
    lines: DataFrame, stock: DataFrame, key: str = "site", seq: str = "seq", hot_lines: int = HOT_LINES, block: int = 1 << 16,
    hot_rows: int | None = None, rounds: list | None = None,
) -> DataFrame:
    """(key, seq, accepted): an order (key, seq) is accepted when all its items are in stock at its turn.

    ``lines``: key, seq (integer, unique order number within the key), item, quantity; ``stock``: key, item, amount, of which
    several rows add up. Amounts are compared exactly, as integers or decimals. An order with a null or negative quantity is
    never accepted. ``rounds``, if given, takes the lines that each round of the large keys began with. ``hot_rows`` is the most
    rows of a key in a task of a running sum; where it is not given, ``hot_lines``, but ``HOT_LINES`` at least.
    """
    whole = all(isinstance(df.schema[c].dataType, IntegralType) for df, c in ((lines, "quantity"), (stock, "amount")))
    kind = "bigint" if whole else "decimal(28,9)"
    asked = F.col("quantity").cast(kind)
    lines = lines.groupBy(key, seq, "item").agg(
        F.coalesce(F.sum(asked), F.lit(0)).cast(kind).alias("quantity"), F.bool_and(F.coalesce(asked >= 0, F.lit(False))).alias("sound")
    )
    stock = stock.groupBy(key, "item").agg(F.coalesce(F.sum(F.col("amount").cast(kind)), F.lit(0)).cast(kind).alias("amount"))
    schema = f"{key} {lines.schema[key].dataType.simpleString()}, {seq} {lines.schema[seq].dataType.simpleString()}, accepted boolean"
    sizes = lines.groupBy(key).agg(F.count("*").alias("__n"))
    heavy = sizes.filter(F.col("__n") > hot_lines).select(key)
    known = heavy.limit(1).count() > 0
    if not known:
        return _fold(lines, stock, key, seq, schema)
    heavy = stable(heavy)
    # running sums need no fold: with few lines to a fold, keys are still not cut into ever more pieces, each sampled by the driver
    hot = hot_rows if hot_rows is not None else max(hot_lines, HOT_LINES)
    big = _rounds(lines.join(heavy, key, "left_semi"), stock.join(heavy, key, "left_semi"), key, seq, block, hot, hot_lines, rounds)
    return _fold(lines.join(heavy, key, "left_anti"), stock.join(heavy, key, "left_anti"), key, seq, schema).unionByName(big)
