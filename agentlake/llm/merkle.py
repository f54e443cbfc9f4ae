"""Merkle manifest of a dataset by butterfly exchange.

Leaves are hashed where the rows are read; only digests move. Per group they are put in order, numbered without a window
over the group, and cut into aligned blocks of ``fanout ** height`` leaves, each a small tree of its own. Then blocks swap
roots in rounds: in round r, the blocks that agree in all digits of their number but the r-th send each other the root of
the tree they belong to so far, and each of them hashes the parent for itself. So every block knows its ancestors and their
siblings when the rounds end, and nothing has to come down from the root. Blocks of an incomplete tree answer for the
places it lacks. The roots of the groups meet in the same way.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agentlake.core import spread, stable

FANOUT, HEIGHT = 8, 4


def leaf_hash(columns: Iterable[Column]) -> Column:
    """Digest of a row: each value as ``-`` if null, else its number of bytes, a colon and itself."""
    parts = []
    for c in columns:
        s = c.cast("string")
        parts.append(F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s)))
    return F.sha2(F.concat(*parts), 256)


def fold(leaf: Column, left: Column, right: Column) -> Column:
    """The root that a leaf and the siblings of its path give."""
    pairs = F.zip_with(left, right, lambda lo, hi: F.struct(lo.alias("lo"), hi.alias("hi")))
    return F.aggregate(pairs, leaf, lambda at, x: F.sha2(F.concat(x["lo"], at, x["hi"]), 256))


def proof_hash(left: Column, right: Column) -> Column:
    """Digest of all siblings of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.zip_with(left, right, lambda lo, hi: F.concat(lo, hi)), ""), 256)


def placed(df: DataFrame, by: str, order: list[str]) -> DataFrame:
    """``df`` with ``pos``, the place of a row in its group (from 0), and ``size``, the rows of the group.

    Rows are sorted by ranges over all groups, so a group of any size lies in as many partitions as it needs; the table of
    offsets has one row per group and partition.
    """
    keys = [by, *order, "_m"]
    ranged = df.withColumn("_m", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    frozen = stable(ranged.select(*df.columns, F.monotonically_increasing_id().alias("_at")))
    part = F.shiftright("_at", 33)
    runs = frozen.groupBy(F.col(by).alias("_by"), part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    whole = Window.partitionBy("_by")
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.select(
        "_by", "_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(whole).alias("size")
    )
    return frozen.join(offsets, (F.col(by) == F.col("_by")) & (part == F.col("_part"))).select(
        *df.columns, (F.col("_before") + F.col("_at") - F.col("_first")).alias("pos"), "size"
    )


def levels(leaves: list[str], fanout: int, height: int | None) -> list[list[str]]:
    """The nodes of a small tree by level; ``height`` levels, or as many as it takes to one node."""
    out = [leaves]
    while len(out) <= height if height is not None else len(out[-1]) > 1:
        low = out[-1]
        out.append([sha256("".join(low[i : i + fanout]).encode()).hexdigest() for i in range(0, len(low), fanout)])
    return out


def exchange(state: DataFrame, fanout: int) -> DataFrame:
    """Rounds of swaps among the blocks of each tree, until every block holds the tree's root.

    ``state``: tree, block (its number from 0), n (blocks of the tree), root, left, right (siblings so far). A message is a
    root; per round, a block gets as many as the parent has children.
    """
    state = stable(state)
    most = state.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    span = 1
    while span < most:
        node = F.expr(f"block div {span}")
        at = state.select("*", node.alias("node"), (F.col("block") % span).alias("lane"), F.expr(f"block div {span * fanout}").alias("parent"))
        at = at.select("*", F.least(F.lit(span), F.col("n") - F.col("node") * span).alias("width"),
                       F.least(F.lit(span), F.col("n") - F.col("parent") * span * fanout).alias("lanes"))
        places = F.sequence(F.col("lane"), F.col("lanes") - 1, F.col("width"))
        sent = at.where(F.col("n") > span).select(
            F.col("tree").alias("_t"), F.col("parent").alias("_p"), F.explode(places).alias("_l"), F.struct("node", "root").alias("x")
        )
        got = sent.groupBy("_t", "_p", "_l").agg(F.sort_array(F.collect_list("x")).alias("xs"))  # at most ``fanout`` of them
        met = at.join(got, (F.col("tree") == F.col("_t")) & (F.col("parent") == F.col("_p")) & (F.col("lane") == F.col("_l")), "left")
        side = lambda test: F.array_join(F.transform(F.filter("xs", test), lambda x: x["root"]), "")
        grown = lambda old, more: F.when(F.col("xs").isNull(), F.col(old)).otherwise(F.array_append(old, more)).alias(old)
        up = F.sha2(F.array_join(F.col("xs.root"), ""), 256)
        state = stable(met.select(
            "tree", "block", "n", F.when(F.col("xs").isNull(), F.col("root")).otherwise(up).alias("root"),
            grown("left", side(lambda x: x["node"] < F.col("node"))), grown("right", side(lambda x: x["node"] > F.col("node"))),
        ))
        span *= fanout
    return state


def manifest(
    docs: DataFrame, columns: Iterable[str], key: str, group: str, carry: Mapping[str, Column] | None = None,
    fanout: int = FANOUT, height: int = HEIGHT,
) -> DataFrame:
    """One row per row of ``docs``: ``key, leaf, subroot, root``, ``left`` and ``right`` (siblings of its path, by level).

    ``leaf`` is ``leaf_hash`` of ``columns``. Leaves of a ``group`` ascend by ``key``, a null key first, equal keys by leaf;
    ``fanout`` consecutive nodes become one until one is left, the ``subroot``; subroots ascend by the group, null first, and
    give the ``root`` in the same way. ``carry`` names further expressions over ``docs`` that come back with their row.
    Repeated rows are leaves each; an empty table gives an empty one; columns of ``docs`` may have any names.
    """
    carry = dict(carry or {})
    more, spare = list(carry), [f"_c{i}" for i in range(len(carry))]
    tree = F.coalesce(F.concat(F.lit("+"), F.col(group).cast("string")), F.lit(""))  # bytewise as the group, null first
    # written down, since sorting by ranges reads its input twice
    leaves = stable(spread(docs).select(
        F.col(key).alias("k"), tree.alias("tree"), leaf_hash(F.col(c) for c in columns).alias("leaf"), *[carry[c].alias(s) for c, s in zip(more, spare)]
    ))
    block = fanout**height
    inside = placed(leaves, "tree", ["k", "leaf"]).withColumn("block", F.expr(f"pos div {block}"))
    by_block = inside.groupBy("tree", "block")

    def grown(t: pa.Table) -> list[list[str]]:
        return levels(t.column("leaf").to_pylist(), fanout, height if t.column("size")[0].as_py() > block else None)

    def roots(t: pa.Table) -> pa.Table:
        first = t.select(["tree", "block", "size"]).slice(0, 1)
        return first.append_column("root", pa.array([grown(t.sort_by("pos"))[-1][0]]))

    bottom = by_block.applyInArrow(roots, "tree string, block long, size long, root string")
    none = F.array().cast("array<string>")
    subtrees = exchange(
        bottom.select("tree", "block", F.expr(f"(size + {block - 1}) div {block}").alias("n"), "root", none.alias("left"), none.alias("right")), fanout
    )
    groups = placed(subtrees.where("block = 0").select(F.lit(0).alias("one"), "tree", F.col("root").alias("subroot")), "one", ["tree"])
    top = exchange(
        groups.select(F.lit("").alias("tree"), F.col("pos").alias("block"), F.col("size").alias("n"), F.col("subroot").alias("root"),
                      none.alias("left"), none.alias("right")), fanout,
    )
    top = groups.select(F.col("tree").alias("_tree"), "subroot", "pos").join(
        top.select(F.col("block").alias("pos"), F.col("root").alias("whole"), F.col("left").alias("tl"), F.col("right").alias("tr")), "pos"
    )
    upper = subtrees.join(top, F.col("tree") == F.col("_tree")).select(
        "tree", "block", "subroot", F.col("whole").alias("root"), F.concat("left", "tl").alias("left"), F.concat("right", "tr").alias("right")
    )
    kind = {f.name: f.dataType.simpleString() for f in leaves.schema.fields}
    kept = ["k", "leaf", *spare]
    schema = ", ".join([*(f"{c} {kind[c]}" for c in kept), "subroot string, root string, `left` array<string>, `right` array<string>"])

    def paths(t: pa.Table, above: pa.Table) -> pa.Table:
        t, up = t.sort_by("pos"), above.to_pylist()[0]
        tree = grown(t)[:-1]
        left, right = [], []
        for i in range(len(t)):
            lo, hi, at = [], [], i
            for nodes in tree:
                begin = at - at % fanout
                lo.append("".join(nodes[begin:at]))
                hi.append("".join(nodes[at + 1 : begin + fanout]))
                at //= fanout
            left.append(lo + up["left"])
            right.append(hi + up["right"])
        text, texts = pa.string(), pa.list_(pa.string())
        return pa.table(
            [*(t.column(c) for c in kept), pa.array([up["subroot"]] * len(t), text), pa.array([up["root"]] * len(t), text),
             pa.array(left, texts), pa.array(right, texts)],
            [*kept, "subroot", "root", "left", "right"],
        )

    out = by_block.cogroup(upper.groupBy("tree", "block")).applyInArrow(paths, schema)
    return out.select(F.col("k").alias(key), "leaf", "subroot", "root", "left", "right", *[F.col(s).alias(c) for c, s in zip(more, spare)])
