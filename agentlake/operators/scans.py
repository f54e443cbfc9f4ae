"""Running totals, dense numbering and first-k that survive one key holding a third of all rows.

A plain ``sum().over(partitionBy(key))`` sends all rows of a key to one task. Keys are counted first (a map-side
combined aggregate over the key columns); where no key is heavy the plain window is the best plan and is used. The rows
of a heavy key are cut into slices that follow the order (a day, a block of ids): slice totals are aggregated map-side,
their running offsets are computed over one small row per slice, and the row-level window only sees one (key, slice).
A slice that is still heavy, such as one day with most of the rows, is cut again by sampled splitters of the whole order.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agentlake.core import stable

_BLOCK = 1 << 16
_MOST_HEAVY = 200
HOT_ROWS = 2_000_000


def id_slice(col: str, block: int = _BLOCK) -> Column:
    """Order-preserving slice of a non-negative integer id."""
    return F.floor(F.col(col) / F.lit(block))


def heavy_keys(df: DataFrame, keys: Sequence[str], hot_rows: int) -> list:
    """Keys with more than ``hot_rows`` rows; at most ``_MOST_HEAVY + 1`` of them are brought to the driver."""
    sizes = df.groupBy(*keys).agg(F.count("*").alias("__n")).filter(F.col("__n") > hot_rows)
    return sizes.limit(_MOST_HEAVY + 1).collect()


def is_heavy(df: DataFrame, keys: Sequence[str], hot_rows: int) -> Column | None:
    """Condition for rows that need slices: none, those of a short list of keys, or all rows."""
    if not keys:
        return F.lit(True)
    heavy = heavy_keys(df, keys, hot_rows)
    if not heavy:
        return None
    if len(heavy) > _MOST_HEAVY:
        return F.lit(True)
    types = {f.name: f.dataType for f in df.schema.fields}
    same = [
        reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.lit(row[k]).cast(types[k])) for k in keys]) for row in heavy
    ]
    return reduce(lambda a, b: a | b, same)


def _cut_again(cut: DataFrame, keys: Sequence[str], order: Sequence[Column | str], hot_rows: int) -> DataFrame:
    """Add ``__part``, which never decreases along ``order`` within a (key, slice): 0, but for the rows of slices with more
    than ``hot_rows`` rows, which get the number of their piece of a range partitioning by the whole order.

    Splitters are sampled, so pieces are of about equal size, a quarter of ``hot_rows`` at most on average. Rows that are
    equal in the order may part by a hash of the row, since their order is open; only rows equal in everything stay together.
    """
    over = is_heavy(cut.filter("__hot"), [*keys, "__slice"], hot_rows)
    if over is None:
        return cut.withColumn("__part", F.lit(0))
    hot = cut.filter(F.col("__hot") & over)
    pieces = max(cut.sparkSession.sparkContext.defaultParallelism, -(-4 * hot.count() // hot_rows))
    plain = [f.name for f in cut.schema.fields if not re.search("map<|variant|interval", f.dataType.simpleString())]
    placed = hot.repartitionByRange(pieces, *keys, "__slice", *order, F.xxhash64(*plain))
    # frozen: totals and rows must see the same pieces
    placed = stable(placed.withColumn("__part", F.spark_partition_id()))
    return cut.filter(~(F.col("__hot") & over)).withColumn("__part", F.lit(0)).unionByName(placed)


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    slice_by: Column,
    sums: Mapping[str, Column],
    inclusive: bool = True,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add one running sum per entry of ``sums``; ``slice_by`` must never decrease along ``order``.

    With ``inclusive=False`` the current row is left out (the sum over prior rows). A null slice stands where the order puts
    its nulls. No task gets more than about ``hot_rows`` rows of a key, however the rows lie in the slices.
    """
    keys, last = list(keys), 0 if inclusive else -1
    heavy = is_heavy(df, keys, hot_rows)
    vals = {n: f"__v_{n}" for n in sums}
    # the type of a plain sum, on either path
    kinds = {n: df.agg(F.sum(c).alias(n)).schema[n].dataType for n, c in sums.items()}
    if heavy is None:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, last)
        return df.withColumns({n: F.coalesce(F.sum(c).over(w), F.lit(0)).cast(kinds[n]) for n, c in sums.items()})
    cut = df.withColumns({"__hot": heavy, "__slice": F.when(heavy, slice_by), **{vals[n]: c for n, c in sums.items()}})
    cut = _cut_again(cut, keys, order, hot_rows)
    by_slice = cut.filter("__hot").groupBy(*keys, "__slice", "__part").agg(*[F.sum(vals[n]).alias(f"__t_{n}") for n in sums])
    nulls_last = not isinstance(order[0], str) and "NULLS LAST" in str(order[0])
    slices = F.asc_nulls_last("__slice") if nulls_last else F.asc("__slice")
    before = Window.partitionBy(*keys).orderBy(slices, "__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_slice.select(
        *[F.col(k).alias(f"__k_{k}") for k in keys],
        F.col("__slice").alias("__k_slice"),
        F.col("__part").alias("__k_part"),
        *[F.coalesce(F.sum(f"__t_{n}").over(before), F.lit(0)).alias(f"__o_{n}") for n in sums],
    )
    match = [F.col("__slice").eqNullSafe(F.col("__k_slice")), F.col("__part") == F.col("__k_part")]
    match += [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys]
    joined = cut.join(offsets, reduce(lambda a, b: a & b, match), "left")
    inside = Window.partitionBy(*keys, "__slice", "__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, last)
    return joined.select(
        *[F.col(c) for c in df.columns],
        *[
            (F.coalesce(F.col(f"__o_{n}"), F.lit(0)) + F.coalesce(F.sum(vals[n]).over(inside), F.lit(0))).cast(kinds[n]).alias(n)
            for n in sums
        ],
    )


def numbered(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], slice_by: Column, name: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Dense 1-based number per key in ``order`` (all rows when ``keys`` is empty)."""
    return running(df, keys, order, slice_by, {name: F.lit(1).cast("long")}, hot_rows=hot_rows)


def numbered_in_file_order(df: DataFrame, name: str) -> DataFrame:
    """Dense 1-based number in file order, without a sort and without a single-task window over rows.

    The order of rows read from files is that of the files' paths, of the pieces of a file, and of the rows in a piece; a
    task may hold pieces of several files, in any order. A file with records over several lines is one piece. Rows that come
    from no file are numbered in the order of their partitions. The checkpoint freezes the numbers inside the tasks; the
    table of offsets has one row per piece.
    """
    place = [F.lit("").alias("__path"), F.shiftright("__mid", 33).alias("__begin")]
    marked = df.withColumn("__mid", F.monotonically_increasing_id())
    if df.inputFiles():
        try:
            marked = df.select(*df.columns, "_metadata.file_path", "_metadata.file_block_start").toDF(*df.columns, "__path", "__begin")
            marked = marked.withColumn("__mid", F.monotonically_increasing_id())
            place = [F.col("__path"), F.col("__begin")]
        except AnalysisException:
            pass  # what was done to the rows since they were read hides the files
    frozen = stable(marked.select(*df.columns, "__mid", *place))
    sizes = frozen.groupBy("__path", "__begin").agg(F.count("*").alias("__n"), F.min("__mid").alias("__first"))
    before = Window.orderBy("__path", "__begin").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col("__path").alias("__p"), F.col("__begin").alias("__b"), "__first", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off")
    )
    same = (F.col("__path") == F.col("__p")) & (F.col("__begin") == F.col("__b"))
    return frozen.join(offsets, same).select(*df.columns, (F.col("__off") + F.col("__mid") - F.col("__first") + 1).alias(name))


def first_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """First ``k`` rows per key. The planner adds a group limit before the shuffle, so a task hands on k rows per key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)


def latest(df: DataFrame, keys: Sequence[str], by: Sequence[Column]) -> DataFrame:
    """The row of each key with the largest ``by``; a map-side combined aggregate, no window."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*by)).alias("__r"))
    return picked.select(*keys, *[F.col(f"__r.{c}").alias(c) for c in rest])


def one_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: the one whose other columns, written as JSON, come first. No arbitrary choice between copies."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    row = F.struct(*[F.col(c) for c in rest])
    best = df.groupBy(*keys).agg(F.min_by(row, F.to_json(row, {"ignoreNullFields": "false"})).alias("__r"))
    return best.select(*keys, *[F.col(f"__r.{c}").alias(c) for c in rest]).select(*df.columns)


def lookback(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    slice_by: Column,
    exprs: Mapping[str, tuple],
    rows: int,
    seq: str = "seq",
    block: int = _BLOCK,
) -> DataFrame:
    """Windows that reach at most ``rows`` rows back, plus the dense number ``seq`` per key.

    ``exprs`` maps a name to ``("lag", column, offset)`` or ``(agg, column)`` over the current and the ``rows`` prior
    rows. Rows are numbered, cut into blocks of ``block`` numbers, and the last ``rows`` rows of a block are copied
    to the next one, so a window partition never holds more than ``block + rows`` rows.
    """
    keys = list(keys)
    n = numbered(df, keys, order, slice_by, seq).withColumn("__b", F.floor((F.col(seq) - 1) / block))
    reach = F.when((F.col(seq) - 1) % block >= block - rows, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    spread = n.withColumn("__halo", F.explode(reach)).withColumn("__b", F.col("__b") + F.col("__halo"))
    w = Window.partitionBy(*keys, "__b").orderBy(seq)
    back = w.rowsBetween(-rows, 0)
    cols = []
    for name, spec in exprs.items():
        if spec[0] == "lag":
            cols.append(F.lag(spec[1], spec[2]).over(w).alias(name))
        else:
            cols.append(getattr(F, spec[0])(spec[1]).over(back).alias(name))
    out = spread.select(*df.columns, seq, "__halo", *cols)
    return out.filter(F.col("__halo") == 0).drop("__halo")


def paged_lists(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    slice_by: Column,
    item: Column,
    page_rows: int = 1000,
    out: str = "items",
) -> DataFrame:
    """Ordered lists per key as numbered pages: a page is bounded, a key has as many pages as it needs."""
    n = numbered(df.withColumn("__item", item), keys, order, slice_by, "__n")
    page = F.floor((F.col("__n") - 1) / page_rows).alias("page")
    items = F.transform(F.array_sort(F.collect_list(F.struct("__n", "__item"))), lambda x: x["__item"])
    return n.groupBy(*keys, page).agg(F.count("*").alias("n"), items.alias(out))
