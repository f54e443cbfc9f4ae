"""SimHash near-duplicates by the generalised pigeonhole principle.

Two fingerprints within distance t, cut into m parts with thresholds t1..tm that add up to t - m + 1, are within its
threshold in at least one part (a threshold of -1 skips the part). Correlated bits are put into one part, so that the
others tell more; a dynamic program over the parts picks the thresholds that promise the fewest probes and candidates, as
estimated from all fingerprints; the number of parts is picked the same way. Each fingerprint probes its values within the
threshold of a part, and candidates are verified on all bits.

Exact copies share a fingerprint and are one row in all this. Where many fingerprints share a value of a part, the rows of
that value are told apart further by parts of the remaining bits (again by the pigeonhole principle), level by level.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, combinations, repeat
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from agentlake.core import fits, stable
from agentlake.llm.components import components
from agentlake.llm.rows import texts

#: Words of a shingle, seed of its hash, bits in which linked fingerprints may differ. Fixed values.
SHINGLE, SEED, DISTANCE = 3, 42, 3

#: Numbers of parts that are compared; what a probe costs against the test of one candidate.
PARTS, PROBE_COST = (2, 3, 4), 4.0

#: Fingerprints of one value of a part beyond which the value is told apart further, and how often.
HOT, LEVELS = 512, 4

#: Shingles that are counted at once.
CHUNK = 1 << 15


def fingerprint(text: str | None) -> int:
    """The fingerprint of one text as an unsigned integer; 0 without words."""
    words = (text or "").encode().lower().split()  # on bytes, both know ASCII only
    n = max(1, len(words) - SHINGLE + 1) if words else 0
    shingles = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE)))) if len(words) >= SHINGLE else iter([b" ".join(words)] if words else [])
    hashes = map(xxhash.xxh64_intdigest, shingles, repeat(SEED))
    ones = np.zeros(64, dtype=np.int64)
    for begin in range(0, n, CHUNK):
        part = np.fromiter(hashes, dtype=">u8", count=min(CHUNK, n - begin))
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


@F.arrow_udf(LongType())
def _fingerprints(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        yield pa.array(np.array([fingerprint(t.as_py()) for t in batch], dtype=np.uint64).view(np.int64))


def fingerprints(docs: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """``keep`` and ``fp`` (the fingerprint's bits as a long) of every row; no shuffle."""
    return texts(docs, *keep, text=text).select(*keep, _fingerprints("text").alias("fp"))


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def bit_counts(fps: DataFrame) -> np.ndarray:
    """How many fingerprints have both bit i and bit j, as a 64 x 64 matrix; summed in the tasks, of fixed size."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((64, 64))
        for b in batches:
            bits = np.unpackbits(b["fp"].to_numpy().astype(">i8").view(np.uint8).reshape(-1, 8), axis=1).astype(np.float32)[:, ::-1]
            total += bits.T @ bits
        yield pd.DataFrame({"at": range(4096), "n": total.ravel()})

    rows = fps.select("fp").mapInPandas(count, "at int, n double").groupBy("at").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(4096)
    for r in rows:
        out[r["at"]] = r["n"]
    return out.reshape(64, 64)


def grouped_bits(both: np.ndarray, n: int, m: int) -> list[list[int]]:
    """m parts of nearly equal size: each starts with the free bit of most correlation and takes the bits most like it."""
    p = np.diag(both) / max(n, 1)
    cov = both / max(n, 1) - np.outer(p, p)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    like = np.abs(cov / np.outer(spread, spread))
    np.fill_diagonal(like, 0.0)
    free, parts = list(range(64)), []
    for k in range(m):
        size = (64 - sum(map(len, parts))) // (m - k)
        first = max(free, key=lambda b: (like[b, free].sum(), -b))
        part = [first]
        free.remove(first)
        while len(part) < size:
            nxt = max(free, key=lambda b: (like[b, part].sum(), -b))
            part.append(nxt)
            free.remove(nxt)
        parts.append(sorted(part))
    return parts


def thresholds(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """The thresholds (from -1 on) of least cost that add up to ``total``; ``costs[i][t + 1]`` is what t costs in part i."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for part in costs:
        new: dict[int, tuple[float, list[int]]] = {}
        for s, (c, ts) in best.items():
            for t, more in enumerate(part, -1):
                if s + t not in new or c + more < new[s + t][0]:
                    new[s + t] = (c + more, [*ts, t])
        best = new
    return best[total]


def plan(fps: DataFrame, distance: int = DISTANCE) -> list[tuple[list[int], int]]:
    """The parts (lists of bits) and their thresholds for these distinct fingerprints."""
    n = fps.count()
    both = bit_counts(fps)
    layouts = {m: grouped_bits(both, n, m) for m in PARTS if m <= distance + 1}
    masks = [(m, i, _signed(sum(1 << b for b in part))) for m, parts in layouts.items() for i, part in enumerate(parts)]
    cut = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col("fp").bitwiseAND(F.lit(mask)).alias("v")) for k, (_, _, mask) in enumerate(masks)]))
    same = fps.select(cut.alias("c")).groupBy("c.k", "c.v").agg(F.count(F.lit(1)).cast("double").alias("n"))
    pairs = {r["k"]: r["pairs"] for r in same.groupBy("k").agg(F.sum(F.col("n") * (F.col("n") - 1) / 2).alias("pairs")).collect()}
    p = np.diag(both) / max(n, 1)
    differ = 2 * p * (1 - p)
    odds = differ / np.maximum(1 - differ, 1e-9)
    best = None
    for m, parts in layouts.items():
        costs = []
        for i, part in enumerate(parts):
            # chance of k differing bits against none, for bits taken as independent
            ways = np.array([1.0] + [0.0] * distance)
            for b in part:
                ways[1:] += ways[:-1] * odds[b]
            met = pairs.get(next(k for k, x in enumerate(masks) if x[:2] == (m, i)), 0.0)
            row, probes = [0.0], 0
            for t in range(distance + 1):
                probes += comb(len(part), t)
                row.append(PROBE_COST * n * probes + max(met, 1.0) * ways[: t + 1].sum() * (1 if t == 0 else 2))
            costs.append(row)
        cost, ts = thresholds(costs, distance - m + 1)
        if best is None or cost < best[0]:
            best = (cost, list(zip(parts, ts)))
    return best[1]


def links(fps: DataFrame, parts: list[tuple[list[int], int]], distance: int = DISTANCE, hot: int = HOT) -> DataFrame:
    """Pairs ``a < b``, each once, of distinct fingerprints ``fp`` that differ in 1 to ``distance`` bits."""
    spark = fps.sparkSession
    probes, index = [], []

    # a pair that an earlier part would let pass is left to that part, so every pair is made once
    earlier: list[tuple[int, int]] = []

    def prior(masks: list[tuple[int, int]]):
        held = F.array(*[F.struct(F.lit(m).cast("long").alias("mask"), F.lit(t).alias("t")) for m, t in masks])
        return held.cast("array<struct<mask:bigint,t:int>>")

    def probe(k: int, mask: int, before):
        value = lambda flip: F.xxhash64(F.lit(k), F.col("fp").bitwiseXOR(flip).bitwiseAND(F.lit(mask)))
        return lambda flip: F.struct(value(flip).alias("key"), F.lit(mask).alias("used"), before.alias("prior"))

    for k, (bits, t) in enumerate(parts):
        if t < 0:
            continue
        mask = _signed(sum(1 << b for b in bits))
        value = F.xxhash64(F.lit(k), F.col("fp").bitwiseAND(F.lit(mask)))
        index.append(F.struct(value.alias("key"), F.lit(mask).alias("used")))
        flips = [_signed(sum(1 << b for b in some)) for some in chain.from_iterable(combinations(bits, d) for d in range(t + 1))]
        probes.append(F.transform(F.lit(np.array(flips, dtype=np.int64)), probe(k, mask, prior(earlier))))
        earlier.append((mask, t))
    right = stable(fps.select("fp", F.explode(F.array(*index)).alias("x")).select("fp", "x.*"))
    left = fps.select("fp", F.explode(F.concat(*probes)).alias("x")).select("fp", "x.*")
    used = {_signed(sum(1 << b for b in bits)) for bits, t in parts if t >= 0}
    order = [b for bits, _ in parts for b in bits]
    found = []
    far = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    for level in range(LEVELS + 1):
        busy = stable(right.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot).select("key")) if level < LEVELS else None
        some = busy is not None and bool(busy.limit(1).count())
        if some:
            # values that few share are joined now, the others go on with parts of the bits not used yet
            few = F.broadcast(busy) if fits(busy, 200_000) else busy
            calm_left, calm_right = left.join(few, "key", "left_anti"), right.join(few, "key", "left_anti")
        else:
            calm_left, calm_right = left, right
        mine = calm_left.select("key", F.col("fp").alias("a"), "prior")
        differ = F.col("a").bitwiseXOR(F.col("b"))
        first = F.forall("prior", lambda p: F.bit_count(differ.bitwiseAND(p["mask"])) > p["t"])
        pair = mine.join(calm_right.select(F.col("key").alias("_key"), F.col("fp").alias("b")), (F.col("key") == F.col("_key")) & (F.col("a") < F.col("b")) & (far <= distance) & first)
        found.append(pair.select("a", "b"))
        if not some:
            break
        cut, after = [], set()
        for mask in used:
            free = [b for b in order if not mask >> b & 1]
            subs = [_signed(sum(1 << int(b) for b in sub)) for sub in np.array_split(free, distance + 1)]
            for j, sub in enumerate(subs):
                cut.append((mask, j, sub, mask | sub, [(x, 0) for x in subs[:j]]))
                after.add(mask | sub)
        cuts = F.broadcast(spark.createDataFrame(cut, "used long, j int, sub long, next long, more array<struct<mask:bigint,t:int>>"))
        finer = F.xxhash64("key", "j", F.col("fp").bitwiseAND(F.col("sub"))).alias("key")
        left, right = (side.join(few, "key", "left_semi").join(cuts, "used") for side in (left, right))
        left = left.select("fp", finer, F.col("next").alias("used"), F.concat("prior", "more").alias("prior"))
        right = stable(right.select("fp", finer, F.col("next").alias("used")))
        used = after
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", distance: int = DISTANCE) -> DataFrame:
    """``key, fp, component_id`` of every row: the smallest key reachable by links, itself included.

    Null and empty texts have fingerprint zero and are linked like any other. Null keys take no part in the minimum.
    Repeated rows keep their rows; an empty table gives an empty one; columns beside the two named do not matter.
    """
    marked = stable(fingerprints(docs.select(F.col(key).alias("doc_key"), F.col(text).alias("text")), "doc_key"))
    per = stable(marked.groupBy("fp").agg(F.min("doc_key").alias("low")))
    return _labelled(marked, per, distance).withColumnRenamed("doc_key", key)


def _labelled(marked: DataFrame, per: DataFrame, distance: int) -> DataFrame:
    fps = per.select("fp")
    group = components(links(fps, plan(fps, distance), distance))
    linked = stable(per.join(group.select(F.col("node").alias("fp"), "label"), "fp"))
    lowest = linked.groupBy("label").agg(F.min("low").alias("component_id"))
    linked = linked.join(lowest, "label").select(F.col("fp").alias("_fp"), "component_id")
    all_fp = per.join(linked, F.col("fp") == F.col("_fp"), "left").select(
        F.col("fp").alias("_fp"), F.coalesce("component_id", "low").alias("component_id")
    )
    return marked.join(all_fp, F.col("fp") == F.col("_fp")).drop("_fp")


def first_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", distance: int = DISTANCE) -> DataFrame:
    """The rows of ``docs`` that stay when one of each group of near-duplicates does: the one with the smallest key.

    Where the smallest key has several texts in the group, the smallest hash of a text decides; of rows with that key and
    text one stays. All columns come back, whatever their names.
    """
    text_key = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    held = docs.select(F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("k"), text_key.alias("t")).alias("doc_key"), F.col(text).alias("text"))
    marked = stable(fingerprints(held, "doc_key"))
    per = stable(marked.groupBy("fp").agg(F.min("doc_key").alias("low")))
    first = stable(_labelled(per.select("fp", "low"), per, distance).select("component_id.*").distinct())
    # what stays grows with the rows, so it is joined by a shuffle at every size
    same = F.col("key").eqNullSafe(F.col("k")) & (F.col("text_key") == F.col("t"))
    ids = marked.select(F.col("doc_key.k").alias("key"), F.col("doc_key.t").alias("text_key"))
    times = stable(ids.join(first, same).groupBy("k", "t").agg((F.count(F.lit(1)) > 1).alias("often")))
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(key).alias("key"), text_key.alias("text_key"))
    once, often = times.where("NOT often"), times.where("often")
    kept = rows.join(once, same, "left_semi")
    if not often.isEmpty():
        kept = kept.unionByName(rows.join(often, same, "left_semi").dropDuplicates(["key", "text_key"]))
    return kept.select("row.*")
