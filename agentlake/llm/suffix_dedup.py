"""Repeated passages by external induced sorting.

A byte goes if it is in a string of ``LENGTH`` bytes that also starts elsewhere. Which starts are such is read off sorted
suffixes and the prefixes they have in common with their neighbours:

1. **Sampling.** Of every ``LENGTH``-byte string the smallest hash of a short gram marks an anchor. Equal strings have equal
   anchors, so only anchors whose gram occurs twice or more go on; what has no repeat is never sorted. (The grams that repeat
   are kept as one bitmap of fixed size; a false hit only costs work.)
2. **Sorting the anchors.** The suffixes at anchors go to the shard of their gram and are sorted there, by the gram and what
   follows it, with Spark's external sort, which spills to disk. Neighbours' common prefixes are counted.
3. **Induction.** The suffixes that start one, two, ... bytes before their anchors follow from this order, step by step: a
   stable distribution by the byte in front keeps the order of the rest, and the common prefix of new neighbours is one more
   than the smallest between their old places. All groups of a batch take a step together.

Shards of any size pass through a task in batches of whole groups. The groups of a gram with too many anchors for that, as
in a passage or a pattern that a large part of all texts shares, are cut by the distance of the starts from their anchor, and
equal surroundings become one row before they are sorted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from agentlake.core import fits, stable
from agentlake.llm.rows import small_batches, texts

#: Bytes of a repeated string and of the gram that marks an anchor.
LENGTH, GRAM = 200, 32

#: Bits of the bitmap of repeated grams (16 MB), the same for any corpus.
BITMAP_BITS = 1 << 27

#: Anchors of one gram beyond which its group is cut; anchors of one batch; starts of a row of a cut group; bytes of a text
#: that are looked at together.
HOT, BATCH, NARROW, CHUNK = 20_000, 12_000, 21, 8_000_000

_POSITION = (1 << 24) - 1
_U = np.uint64


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A 64-bit hash of the ``gram`` bytes from each position on; ``gram`` is a power of two."""
    h, power, n = data.astype(np.uint64) + _U(1), 0x9E3779B97F4A7C15, 1
    while n < gram:
        h = h[:-n] * _U(power) + h[n:]
        power = power * power % (1 << 64)
        n *= 2
    h ^= h >> _U(32)
    h *= _U(0xD6E8FEB86659FD93)
    return h ^ h >> _U(32)


def anchors(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``hash, position, first start, last start`` of each anchor: the strings from those starts have this anchor."""
    if len(data) < length:
        return (np.zeros(0, np.int64),) * 4
    h = gram_hashes(data, gram)
    # the upper bits order the grams; of equal ones the leftmost is the smallest
    low = (h & ~_U(_POSITION)) | np.arange(len(h), dtype=np.uint64)
    width, n = length - gram + 1, 1
    while 2 * n <= width:
        low = np.minimum(low[:-n], low[n:])
        n *= 2
    if width > n:
        low = np.minimum(low[: len(low) - (width - n)], low[width - n :])
    at = (low & _U(_POSITION)).astype(np.int64)
    begin = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    return h[at[begin]].view(np.int64), at[begin], begin, np.r_[begin[1:], len(at)] - 1


def _chunks(text: str, chunk: int | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """Parts of a text's bytes such that every string of ``LENGTH`` bytes starts in exactly one."""
    data, chunk = np.frombuffer(text.encode(), np.uint8), chunk or CHUNK
    for begin in range(0, max(1, len(data) - LENGTH + 1), chunk):
        yield begin, data[begin : begin + chunk + LENGTH - 1]


def text_anchors(text: str, chunk: int = CHUNK) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``hash, position, fewest, most`` of the anchors of a whole text, in arrays: the strings that start from fewest to most
    bytes before the position have this anchor. Strings of several chunks that share an anchor are one row of it."""
    held = (np.zeros(0, np.int64),) * 4
    for begin, part in _chunks(text, chunk):
        h, at, first, last = anchors(part)
        low, high, at = at - last, at - first, at + begin
        if len(at) and len(held[1]) and at[0] == held[1][0]:
            low[0], high[0] = min(low[0], held[2][0]), max(high[0], held[3][0])
        else:
            h, at, low, high = (np.concatenate(x) for x in zip(held, (h, at, low, high)))
        # the last anchor may be that of the next chunk's first strings too
        yield h[:-1], at[:-1], low[:-1], high[:-1]
        held = h[-1:], at[-1:], low[-1:], high[-1:]
    yield held


def common_prefixes(right: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Bytes that each row has in common with the row before; 0 where the keys differ."""
    out = np.zeros(len(right), np.int32)
    for at in range(1, len(right), 65_536):
        a, b = right[at : at + 65_536], right[at - 1 : at - 1 + len(right[at : at + 65_536])]
        differ = a != b
        first = np.where(differ.any(1), differ.argmax(1), right.shape[1])
        out[at : at + len(a)] = np.minimum(first, np.minimum(size[at : at + len(a)], size[at - 1 : at - 1 + len(a)]))
    out[1:][key[1:] != key[:-1]] = 0
    return out


def _lowest_between(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Smallest of ``values[begin + 1 : end + 1]`` for each pair, by a table over powers of two."""
    span = end - begin
    out = values[end].copy()
    level, n, known = values, 1, 0
    todo = span > 1
    while todo.any():
        # level[i] is the smallest of n values from i on
        now = todo & (span < 2 * n)
        out[now] = np.minimum(level[begin[now] + 1], level[end[now] - n + 1])
        todo &= ~now
        if todo.any():
            level = np.minimum(level[:-n], level[n:])
            n *= 2
    return out


def repeated_starts(key: np.ndarray, left: list[bytes], right: list[bytes], length: int = LENGTH, gram: int = GRAM) -> np.ndarray:
    """Which strings of ``length`` bytes, starting so many bytes before each anchor, start at another anchor of the key too.

    The rows come sorted by ``key`` and ``right``; ``left`` is reversed. The result has a row per anchor and a column per
    number of bytes before it, from 0 to ``length - gram``.
    """
    m, back = len(key), length - gram
    size = np.fromiter(map(len, right), np.int32, m)
    before = np.fromiter(map(len, left), np.int32, m)
    text = np.frombuffer(b"".join(x.ljust(length, b"\0") for x in right), np.uint8).reshape(m, length)
    front = np.frombuffer(b"".join(x.ljust(back, b"\0") for x in left), np.uint8).reshape(m, back) if back else np.zeros((m, 0), np.uint8)
    group = np.cumsum(np.r_[False, key[1:] != key[:-1]])
    order, common = np.arange(m), common_prefixes(text, size, group)
    out = np.zeros((m, back + 1), bool)
    for step in range(back + 1):
        long = common >= length
        hit = long | np.r_[long[1:], False]
        out[order[hit], step] = True
        if step == back:
            break
        # the order of the suffixes that begin one byte further to the front
        place = np.flatnonzero(before[order] > step)
        row = order[place]
        byte = group[row] * 256 + front[row, step]
        move = np.argsort(byte, kind="stable")
        place, byte = place[move], byte[move]
        order = order[place]
        if not len(order):
            break
        same = np.flatnonzero(byte[1:] == byte[:-1]) + 1
        new = np.zeros(len(order), np.int32)
        new[same] = _lowest_between(common, place[same - 1], place[same]) + 1
        common = new
    return out


def _runs(hit: np.ndarray, position: int, low: int, high: int) -> Iterator[tuple[int, int]]:
    """First and last start of each run of hits among the starts ``position - high .. position - low``."""
    some = np.flatnonzero(hit[low : high + 1])
    if len(some):
        cut = np.flatnonzero(np.diff(some) > 1)
        for a, b in zip(np.r_[0, cut + 1], np.r_[cut, len(some) - 1]):
            yield position - low - int(some[b]), position - low - int(some[a])


_FOUND = "h long, uid string, at long, low int, high int, left binary, right binary"
_RUNS = "uid string, first long, last long"


def _anchor_rows(documents: DataFrame, bitmap=None, chunk: int = CHUNK) -> DataFrame:
    """Anchors of ``uid, text``: their hashes alone, or, of those in the bitmap, the bytes around them too."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows, hashes = [], []
            for uid, text in zip(b["uid"], b["text"]):
                data = text.encode() if bitmap is not None else b""
                for h, at, low, high in text_anchors(text, chunk):
                    if bitmap is None:
                        hashes.append(h)
                        continue
                    bits = h & (BITMAP_BITS - 1)
                    for k in np.flatnonzero(bitmap.value[bits >> 3] >> (bits & 7).astype(np.uint8) & 1):
                        p = int(at[k])
                        left, right = data[max(0, p - LENGTH + GRAM) : p][::-1], data[p : p + LENGTH]
                        rows.append((int(h[k]), uid, p, int(low[k]), int(high[k]), left, right))
                    if len(rows) >= 20_000:
                        yield pd.DataFrame(rows, columns=["h", "uid", "at", "low", "high", "left", "right"])
                        rows = []
            if hashes:
                yield pd.DataFrame({"h": np.concatenate(hashes)})
            if rows:
                yield pd.DataFrame(rows, columns=["h", "uid", "at", "low", "high", "left", "right"])

    return documents.mapInPandas(read, "h long" if bitmap is None else _FOUND)


def _bitmap(spark, repeated: DataFrame):
    """The repeated grams as bits, put together in the tasks by pieces of fixed size."""
    bit = F.col("h").bitwiseAND(F.lit(BITMAP_BITS - 1)) + 1  # pieces are numbered from 1, bits in them from 0
    pieces = repeated.groupBy(F.bitmap_bucket_number(bit).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
    out = np.zeros(BITMAP_BITS // 8, np.uint8)
    for r in pieces.collect():  # at most BITMAP_BITS / 32768 rows of 4 KB
        out[(r["bucket"] - 1) * 4096 : r["bucket"] * 4096] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return spark.sparkContext.broadcast(out)


def _induce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Runs of repeated starts from rows sorted by ``h, right``; whole groups at a time."""
    held: list[pd.DataFrame] = []
    for b in batches:
        held.append(b)
        if sum(map(len, held)) < BATCH:
            continue
        rows = pd.concat(held, ignore_index=True)
        h = rows["h"].to_numpy()
        cut = int(np.flatnonzero(h != h[-1]).max(initial=-1)) + 1  # the last group may go on
        if cut:
            yield _induced(rows.iloc[:cut])
        held = [rows.iloc[cut:]]
    if held:
        yield _induced(pd.concat(held, ignore_index=True))


def _induced(rows: pd.DataFrame) -> pd.DataFrame:
    h = rows["h"].to_numpy()
    # groups of one have no partner
    alone = np.r_[True, h[1:] != h[:-1]] & np.r_[h[1:] != h[:-1], True]
    rows, h = rows[~alone], h[~alone]
    out = []
    if len(rows):
        hits = repeated_starts(h, rows["left"].tolist(), rows["right"].tolist())
        some = hits.any(1)
        rows = rows[some]
        for uid, at, low, high, hit in zip(rows["uid"], rows["at"], rows["low"], rows["high"], hits[some]):
            out.extend((uid, a, b) for a, b in _runs(hit, at, low, high))
    return pd.DataFrame(out, columns=["uid", "first", "last"]).astype({"first": "int64", "last": "int64"})


def _narrowed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of anchors cut by the distance of the starts: each new row stands for at most ``NARROW`` starts.

    The bytes that all strings from these starts share are the new key, so only anchors that agree in nearly a whole string
    meet again. The new anchor is the last of the starts; what is in front of it belongs to the others.
    """
    for b in batches:
        rows = []
        for h, uid, at, low, high, left, right in zip(*(b[c] for c in ("h", "uid", "at", "low", "high", "left", "right"))):
            for begin in range(low - low % NARROW, high + 1, NARROW):
                end = min(begin + NARROW - 1, LENGTH - GRAM)
                shared = left[:begin][::-1] + right[: LENGTH - end]
                key = hashlib.md5(b"%d:%d:" % (h, begin) + shared).digest()
                rows.append((
                    int.from_bytes(key[:8], "little", signed=True), uid, at - begin, max(low, begin) - begin, min(high, end) - begin,
                    left[begin:end], left[:begin][::-1] + right[: LENGTH - begin],
                ))
        yield pd.DataFrame(rows, columns=["h", "uid", "at", "low", "high", "left", "right"])


def _strings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Digests of the strings that start at or before each anchor."""
    for b in batches:
        rows = []
        for around, h, n, left, right in zip(b["around"], b["h"], b["n"], b["left"], b["right"]):
            whole, p = left[::-1] + right, len(left)
            for back in range(p + 1):
                s = whole[p - back : p - back + LENGTH]
                if len(s) == LENGTH:
                    rows.append((around, h, back, hashlib.md5(s).digest(), n))
        yield pd.DataFrame(rows, columns=["around", "h", "back", "digest", "n"])


def _runs_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        out = []
        for uid, at, low, high, backs in zip(b["uid"], b["at"], b["low"], b["high"], b["backs"]):
            hit = np.zeros(LENGTH - GRAM + 1, bool)
            hit[list(backs)] = True
            out.extend((uid, x, y) for x, y in _runs(hit, at, low, high))
        yield pd.DataFrame(out, columns=["uid", "first", "last"]).astype({"first": "int64", "last": "int64"})


def _cut_groups(found: DataFrame, hot: int) -> DataFrame:
    """Runs of repeated starts of grams with too many anchors for one task.

    Anchors are cut into rows of few starts with long keys. Equal rows are one from there on: their strings all repeat, and
    the one row stands for them where others look for partners. Keys with too many different rows even so are not sorted:
    their few strings per row are counted by their digests.
    """
    rows = found.mapInPandas(_narrowed, _FOUND)
    rows = stable(rows.withColumn("around", F.md5(F.concat_ws(":", F.md5("left"), F.md5("right")))))
    kinds = stable(rows.groupBy("h", "around").agg(
        F.count(F.lit(1)).alias("n"), *[F.first(c).alias(c) for c in ("uid", "at", "low", "high", "left", "right")]
    ))
    equal = rows.join(kinds.where("n > 1").select("h", "around"), ["h", "around"], "left_semi").select(
        "uid", (F.col("at") - F.col("high")).alias("first"), (F.col("at") - F.col("low")).alias("last")
    )
    # a row that stands for several has had its answer
    once = F.col("n") == 1
    kinds = kinds.withColumns({"low": F.when(once, F.col("low")).otherwise(1), "high": F.when(once, F.col("high")).otherwise(0)})
    sizes = kinds.groupBy("h").agg(F.count(F.lit(1)).alias("rows"), F.max(once.cast("int")).alias("open")).where("rows > 1 AND open = 1")
    sizes = stable(sizes)
    calm = kinds.join(sizes.where(F.col("rows") <= hot).select("h"), "h", "left_semi").select(*found.columns)
    sorted_ = calm.repartition("h").sortWithinPartitions("h", "right").mapInPandas(_induce, _RUNS)
    busy = kinds.join(sizes.where(F.col("rows") > hot).select("h"), "h", "left_semi")
    each = stable(busy.select("around", "h", "n", "left", "right").mapInPandas(_strings, "around string, h long, back int, digest binary, n long"))
    # the same string at another distance from its anchor may be the same place
    often = each.groupBy("h", "back", "digest").agg(F.sum("n").alias("times")).where("times > 1").drop("times")
    hits = each.join(often, ["h", "back", "digest"], "left_semi").groupBy("h", "around").agg(F.collect_set("back").alias("backs"))
    counted = busy.where(once).select("h", "around", "uid", "at", "low", "high").join(hits, ["h", "around"]).mapInPandas(_runs_of, _RUNS)
    return equal.unionByName(sorted_).unionByName(counted)


def repeated_spans(documents: DataFrame, hot: int = HOT, chunk: int = CHUNK) -> DataFrame:
    """``uid, spans`` for the texts of ``uid, text`` (one row each) that lose bytes: ``spans`` are their removed runs,
    ``(begin, end)`` in bytes, end exclusive."""
    spark = documents.sparkSession
    counts = stable(_anchor_rows(documents, chunk=chunk).groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    bitmap = _bitmap(spark, counts)
    found = _anchor_rows(documents, bitmap, chunk)
    busy = stable(counts.where(F.col("n") > hot).select("h"))
    some = bool(busy.limit(1).count())
    if some:
        found = stable(found)
        few = F.broadcast(busy) if fits(busy, 200_000) else busy
        calm = found.join(few, "h", "left_anti")
    else:
        calm = found
    runs = calm.repartition("h").sortWithinPartitions("h", "right").mapInPandas(_induce, _RUNS)
    if some:
        runs = runs.unionByName(_cut_groups(found.join(few, "h", "left_semi"), hot))

    # a run of starts covers LENGTH - 1 bytes beyond its last one; runs of one text are joined where they touch
    order = Window.partitionBy("uid").orderBy("first", "last")
    reach = F.max(F.col("last") + LENGTH).over(order.rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.withColumn("new", F.coalesce((F.col("first") > reach).cast("int"), F.lit(1)))
    runs = runs.withColumn("island", F.sum("new").over(order))
    spans = runs.groupBy("uid", "island").agg(F.min("first").alias("begin"), (F.max("last") + LENGTH).alias("end"))
    return spans.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("begin", "end"))).alias("spans"))


@F.arrow_udf(BinaryType())
def _without(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for text, spans in columns:
        out = []
        for t, found in zip(text, spans):
            data, at, parts = (t.as_py() or "").encode(), 0, []
            for s in (found.as_py() if found.is_valid else None) or ():
                parts.append(data[at : s["begin"]])
                at = s["end"]
            out.append(b"".join([*parts, data[at:]]))
        yield pa.array(out, pa.binary())


def remove_repeats(docs: DataFrame, *keep: str, text: str = "text", hot: int = HOT, chunk: int = CHUNK) -> DataFrame:
    """``keep, n_bytes, spans, kept``: the removed runs of every row's text, and the bytes that are left.

    Equal texts are one in all of this: of ``LENGTH`` bytes or more, all of such a text goes, and it still counts as a place
    where others' strings start. Null texts are empty; null ids and repeated rows keep their rows; an empty table gives an
    empty one; columns not in ``keep`` do not matter.
    """
    small_batches(docs.sparkSession)
    held = texts(docs, *keep, text=text).select(*keep, "text", F.md5("text").alias("_uid"), F.octet_length("text").cast("long").alias("n_bytes"))
    copies = held.groupBy("_uid", "n_bytes").agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) & (F.col("n_bytes") >= LENGTH))
    copies = stable(copies.select(F.col("_uid").alias("uid"), "n_bytes"))
    known = copies.select(F.col("uid").alias("_uid"))
    if fits(known, 200_000):
        known = F.broadcast(known)
    long = held.where(F.col("n_bytes") >= LENGTH).select("_uid", "text")
    one = stable(long.join(known, "_uid", "left_semi").dropDuplicates(["_uid"]))
    singles = long.join(known, "_uid", "left_anti").unionByName(one).select(F.col("_uid").alias("uid"), "text")
    spans = repeated_spans(singles, hot, chunk).join(copies.select("uid"), "uid", "left_anti")
    whole = F.array(F.struct(F.lit(0).cast("long").alias("begin"), F.col("n_bytes").alias("end")))
    marks = stable(spans.unionByName(copies.select("uid", whole.alias("spans"))))
    number = marks.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("spans")), F.lit(0))).first()
    if number[0] <= 300_000 and number[1] <= 1_000_000:  # then at most some 40 MB
        marks = F.broadcast(marks)
    out = held.join(marks, F.col("_uid") == F.col("uid"), "left")
    some = F.col("spans").isNotNull()
    kept = F.when(some, _without(F.when(some, F.col("text")), F.col("spans"))).otherwise(F.col("text").cast("binary"))
    none = F.array().cast("array<struct<begin:bigint,end:bigint>>")
    return out.select(*keep, "n_bytes", F.coalesce("spans", none).alias("spans"), kept.alias("kept"))


def removed_bytes(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["begin"])
