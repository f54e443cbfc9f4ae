"""Mixing sources to target weights by the cube method.

A source's target divided by its size is the number of times each of its documents is expected. The whole part is taken for
certain; the rest is an inclusion probability. The cube method moves these probabilities along directions that change
neither the expected number of documents nor the expected number of words, until each is 0 or 1. Documents are dealt by a
hash to groups of bounded size, so a source of any size is worked on in parallel; each group leaves at most two undecided
documents, which meet in the next, far smaller round. In falling order of size each document is moved until it is settled,
and all others of its group make up for it a little each, so what is left at the end is small. The last few of a source are
settled by landing: of all ways to take them, one of those nearest to their words is drawn; balance goes before chance there.
"""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from agentlake.core import fits, stable
from agentlake.operators.scans import numbered

#: Weights by the order of the sources, the total as a multiple of all sizes, the most a source or document is taken. Fixed.
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2

#: Documents of one group at most, on average; undecided ones of a source that are landed, and the share of the
#: ways to take those among which one is drawn.
GROUP, LANDED, NEAREST = 4096, 12, 256

#: Below this many sources their targets are sent to the tasks; beyond it they are joined by a shuffle.
FEW_SOURCES = 20_000

WORDS = r"([^\x20\x09-\x0D]+)"


def sizes(docs: DataFrame, *keep, source: str = "source", text: str = "text") -> DataFrame:
    """``keep, source, size``: the number of words of every row's text, 0 for null."""
    size = F.size(F.regexp_extract_all(F.col(text), F.lit(WORDS), F.lit(1)))
    return docs.select(*keep, F.col(source).alias("source"), F.when(F.col(text).isNull(), 0).otherwise(size).cast("long").alias("size"))


def targets(sized: DataFrame) -> DataFrame:
    """``source, n_docs, source_size, target`` per source of ``sized`` (``source, size``, and ``n`` equal rows).

    Sources in the order of code points, null last, have the weights in turn. The common factor that turns a weight into a
    target grows as long as sources reach their limit: each round is one sum over the sources.
    """
    per = sized.groupBy("source").agg(F.sum("n").alias("n_docs"), F.sum(F.col("size") * F.col("n")).alias("source_size"))
    spark = sized.sparkSession
    # numbered without a single-task window: a range sort, then offsets by partition
    ordered = per.orderBy(F.col("source").asc_nulls_last())
    place = ordered.rdd.zipWithIndex().map(lambda x: (*x[0], x[1]))
    per = stable(spark.createDataFrame(place, StructType(ordered.schema.fields).add("place", "long")))
    weight = F.element_at(F.lit(list(WEIGHTS)), (F.col("place") % len(WEIGHTS) + 1).cast("int"))
    per = per.withColumn("weight", weight.cast("double")).withColumn("limit", MOST * F.col("source_size").cast("double"))
    want = SHARE * (per.agg(F.sum("source_size")).first()[0] or 0)
    factor = 0.0
    while True:
        full = F.col("limit") <= factor * F.col("weight")
        held, rest = per.agg(F.sum(F.when(full, F.col("limit")).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        new = (want - held) / rest if rest else factor
        if not rest or new <= factor:
            break
        factor = new
    target = F.least(F.col("limit"), F.lit(factor) * F.col("weight"))
    return per.select("source", "n_docs", "source_size", target.alias("target"))


def _walk(units: list[list], rng: random.Random, stop: int, answer) -> list[list]:
    """Moves ``[size, p]``, which come in falling order of size, in place until at most ``stop`` are undecided; returns those.

    The first undecided unit is moved, and ``answer(sizes, room)`` gives how much every other moves for that, or None where
    none can answer; room is p (1 - p), and 0 for the first. The way ends at the nearest wall on one side or the other, with
    chances that leave every probability as it was on average.
    """
    undecided = [u for u in units if 0.0 < u[1] < 1.0]
    size = np.array([u[0] for u in undecided], dtype=np.float64)
    p = np.array([u[1] for u in undecided], dtype=np.float64)
    alive = np.arange(len(p))
    while len(alive) > stop:
        q = p[alive]
        room = q * (1.0 - q)
        room[0] = 0.0
        step = answer(size[alive], room)
        if step is None:
            break
        step[0] = 1.0
        rise, fall = step > 0, step < 0
        up = min(((1.0 - q[rise]) / step[rise]).min(), (q[fall] / -step[fall]).min(initial=np.inf))
        down = min((q[rise] / step[rise]).min(), ((1.0 - q[fall]) / -step[fall]).min(initial=np.inf))
        q = q + (up if rng.random() * (up + down) < down else -down) * step
        q[q < 1e-9] = 0.0
        q[q > 1.0 - 1e-9] = 1.0
        p[alive] = q
        alive = alive[(q > 0.0) & (q < 1.0)]
    for u, v in zip(undecided, p.tolist()):
        u[1] = v
    return [undecided[i] for i in alive]


def _both(size: np.ndarray, room: np.ndarray) -> np.ndarray | None:
    """The others' number of documents falls by one and their words by the first one's size: a line in the size, by room."""
    rest = size - size[0]
    w0, w1, w2 = room.sum(), (room * rest).sum(), (room * rest * rest).sum()
    spread = w0 * w2 - w1 * w1
    if spread > 1e-9 * w0 * w2:
        return -room * (w2 - w1 * rest) / spread
    # one size among the others: they can answer if it is that of the first
    return None if rest.any() else -room / w0


def _words(size: np.ndarray, room: np.ndarray) -> np.ndarray | None:
    """The others' words fall by the first one's size; one without words needs no answer."""
    if size[0] == 0:
        return np.zeros(len(size))
    square = (room * size * size).sum()
    return -room * size * size[0] / square if square > 0 else None


def _flight(units: list[list], rng: random.Random, stop: int = 2) -> list[list]:
    """Moves that keep the documents and the words; where the others of a group are too alike to answer, three at a time."""
    left = _walk(units, rng, stop, _both)
    return left if len(left) <= stop else _by_three(left, rng)


def _by_three(units: list[list], rng: random.Random) -> list[list]:
    """Of three undecided units there is one direction that keeps both sums: it is followed until at most two are left."""
    active: list[list] = []
    for unit in units:
        active.append(unit)
        if len(active) == 3:
            a, b, c = (u[0] for u in active)
            step = (float(b - c), float(c - a), float(a - b))
            if a == b == c:
                step = (1.0, -1.0, 0.0)
            active = _move(active, step, rng)
    return active


def _move(active: list[list], step: tuple, rng: random.Random) -> list[list]:
    top = max(map(abs, step))
    step = [s / top for s in step]
    up = min(((1.0 - u[1]) / s if s > 0 else u[1] / -s) for u, s in zip(active, step) if s)
    down = min((u[1] / s if s > 0 else (1.0 - u[1]) / -s) for u, s in zip(active, step) if s)
    by = up if rng.random() * (up + down) < down else -down
    for u, s in zip(active, step):
        u[1] += by * s
        if u[1] < 1e-9:
            u[1] = 0.0
        elif u[1] > 1.0 - 1e-9:
            u[1] = 1.0
    return [u for u in active if 0.0 < u[1] < 1.0]


def _land(units: list[list], rng: random.Random) -> None:
    """The last ones of a source. Those without words are drawn by themselves; of the ways to take the others, the nearest to
    their words are found, and one of these is drawn by its probability."""
    left = _walk(_walk(units, rng, LANDED, _both), rng, LANDED, _words)
    for u in left:
        if u[0] == 0:
            u[1] = 1.0 if rng.random() < u[1] else 0.0
    left = [u for u in left if u[0]]
    size, p = np.array([u[0] for u in left], dtype=np.float64), np.array([u[1] for u in left], dtype=np.float64)
    ways = (np.arange(1 << len(left))[:, None] >> np.arange(len(left))) & 1
    off = np.abs((ways * size).sum(axis=1) - (size * p).sum()).round(6)
    near = np.argsort(off, kind="stable")[: max(1, len(ways) // NEAREST)]
    chance = np.where(ways[near] == 1, p, 1.0 - p).prod(axis=1)
    for u, taken in zip(left, ways[rng.choices(near.tolist(), chance.tolist())[0]].tolist()):
        u[1] = float(taken)


def _round(undecided: DataFrame, last: bool, seed: int) -> DataFrame:
    schema = undecided.schema
    key = list(undecided.columns)

    def fly(pdf: pd.DataFrame) -> pd.DataFrame:
        # one order whatever the order of arrival; large documents first
        pdf = pdf.sort_values(["size", "_h", "doc_key", "_copy"], ascending=[False, True, True, True], kind="stable", na_position="last")
        rng = random.Random(f"{seed}:{pdf['_h'].iloc[0]}:{len(pdf)}:{last}")
        units = [list(u) for u in zip(pdf["size"].tolist(), pdf["p"].tolist())]
        (_land if last else _flight)(units, rng)
        pdf["p"] = [u[1] for u in units]
        return pdf[key]

    return undecided.groupBy("source", "_group").applyInPandas(fly, schema)


def mix(docs: DataFrame, doc_key: str = "doc_id", source: str = "source", text: str = "text", seed: int = 11) -> DataFrame:
    """``doc_key, source, size, source_size, target, times`` of every row; ``times`` is how often the mix takes it.

    Equal rows are told apart by a number, so reruns agree whatever the order of the input. Null texts have size 0 and a
    null source is a source. An empty table gives an empty one; columns beside the three named do not matter.
    """
    # as strings, ids with and without nulls pass through pandas alike
    rows = sizes(docs, F.col(doc_key).cast("string").alias("doc_key"), source=source, text=text)
    counted = stable(rows.groupBy("doc_key", "source", "size").agg(F.count(F.lit(1)).alias("n")))
    per = stable(targets(counted))
    groups = F.ceil(F.col("n_docs") / GROUP).cast("long")
    most = per.agg(F.max(groups)).first()[0] or 1
    known = per.select(F.col("source").alias("_s"), "source_size", "target", groups.alias("_groups"))
    if fits(known, FEW_SOURCES):
        known = F.broadcast(known)
    units = counted.join(known, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    units = units.select("*", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("_copy")).drop("n")
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    units = units.withColumn("_whole", F.floor(expected).cast("int")).withColumn("p", expected - F.floor(expected))
    units = units.withColumn("_h", F.xxhash64(F.lit(seed), "doc_key", "size", "_copy"))
    left = units.withColumn("_group", F.pmod("_h", "_groups"))
    settled = []
    while True:
        left = stable(_round(left, most == 1, seed))
        settled.append(left.where((F.col("p") == 0.0) | (F.col("p") == 1.0)))
        if most == 1:
            break
        # at most two of each group go on
        most = -(-2 * most // GROUP)
        left = left.where((F.col("p") > 0.0) & (F.col("p") < 1.0))
        left = left.withColumn("_groups", F.ceil(2 * F.col("_groups") / GROUP).cast("long")).withColumn("_group", F.pmod("_h", "_groups"))
    out = settled[0]
    for more in settled[1:]:
        out = out.unionByName(more)
    return out.select(
        F.col("doc_key").cast(docs.schema[doc_key].dataType).alias(doc_key), "source", "size", "source_size", "target",
        (F.col("_whole") + F.col("p").cast("int")).alias("times"),
    )


def repeat(docs: DataFrame, doc_key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken.

    The rows of one id, source and size are interchangeable for the balance; how often they are taken is dealt to them in
    the order of their hashes. All columns come back, whatever their names.
    """
    taken = mix(docs, doc_key, source, text)
    times = taken.groupBy(
        F.col(doc_key).alias("_k"), F.col("source").alias("_s"), F.col("size").alias("_n")
    ).agg(F.sum("times").alias("_all"), F.count(F.lit(1)).alias("_rows"))
    size = F.coalesce(F.size(F.regexp_extract_all(F.col(text), F.lit(WORDS), F.lit(1))), F.lit(0))
    size = F.when(F.col(text).isNull(), 0).otherwise(size).cast("long")
    times = stable(times)
    rows = docs.select(
        F.struct(*docs.columns).alias("row"), F.col(doc_key).alias("key"), F.col(source).alias("source"), size.alias("size"),
        F.xxhash64(*docs.columns).alias("_h"),
    )
    same = F.col("key").eqNullSafe(F.col("_k")) & F.col("source").eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_n"))
    # nearly every row is the only one of its kind and needs no number; the others are numbered within their kind
    out = rows.join(times.where("_rows = 1"), same).select("row", F.col("_all").alias("_times"))
    several = times.where("_rows > 1")
    if not several.isEmpty():
        many = rows.join(several, same).select("row", "_k", "_s", "_n", "_h", "_all", "_rows")
        many = numbered(many, ["_k", "_s", "_n"], ["_h"], F.shiftright("_h", 48), "_at")
        share = F.floor(F.col("_all") / F.col("_rows"))
        more = F.when(F.col("_at") <= F.col("_all") - share * F.col("_rows"), 1).otherwise(0)
        out = out.unionByName(many.select("row", (share + more).alias("_times")))
    out = out.where("_times > 0")
    return out.select("row", F.explode(F.sequence(F.lit(1), F.col("_times").cast("int"))).alias("_copy")).select("row.*")
