"""Document fingerprints from improbable features.

A feature is a window of 32 bytes. Its entropy is one of a thousand levels, and a level is the rarer, the fewer windows of
the whole corpus have it. Of every 32 neighbouring windows the rarest is voted for; windows with enough votes are the
text's features, wherever in the text they stand. In order, and each once, they are inserted into Bloom filters of 2,048
bits, a new one when the last is full. Two fingerprints are compared filter by filter by their common bits, less what chance
would give them, each filter of the smaller with its best partner.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agentlake.core import spread, stable
from agentlake.llm.rows import texts

WINDOW, NEIGHBOURS, VOTES = 32, 32, 8
LEVELS = 1000
#: Windows below this level say next to nothing (runs of one sign); they are chosen where there are no others.
WEAK = LEVELS // 10
BITS, HASHES, PER_FILTER = 2048, 5, 160
#: Standard deviations that common bits must exceed chance by.
BEYOND = 3.0
#: Bytes worked on at once in a task.
PIECE = 1 << 20

_COUNTS = np.arange(WINDOW + 1, dtype=np.float64)
#: c log2(c) for a byte that is c times in a window, in 64ths, so that sums along a text are exact.
_SHARE = np.rint(64 * _COUNTS * np.log2(np.maximum(_COUNTS, 1))).astype(np.int32)
_STEP = np.diff(_SHARE)
_LEVEL = (np.arange(_SHARE[-1], -1, -1, dtype=np.int64) * LEVELS // _SHARE[-1]).astype(np.int16)


def window_levels(x: np.ndarray) -> np.ndarray:
    """Entropy level of the window that begins at each byte.

    A byte that comes in adds what its count adds, a byte that leaves takes it away; the counts of all windows are those of
    equal bytes up to 31 places before and behind.
    """
    n = len(x) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.int16)
    before, behind = np.zeros(len(x), np.uint8), np.zeros(len(x), np.uint8)
    for d in range(1, WINDOW):
        same = (x[d:] == x[:-d]).view(np.uint8)
        before[d:] += same
        behind[:-d] += same
    first = _SHARE[np.bincount(x[:WINDOW], minlength=256)].sum()
    change = _STEP[before[WINDOW:]] - _STEP[behind[: n - 1]]
    return _LEVEL[np.concatenate(([first], first + np.cumsum(change, dtype=np.int64)))]


def _segments(data: list[bytes]) -> Iterator[list[tuple[int, int, int, int, int]]]:
    """Batches of (text, from, to, first start, end of starts): whole texts together, long ones in pieces with what their windows see."""
    batch, size = [], 0
    for i, t in enumerate(data):
        starts = len(t) - WINDOW + 1
        for a in range(0, starts, PIECE):
            b = min(starts, a + PIECE)
            low, high = max(0, a - NEIGHBOURS + 1), min(len(t), b + NEIGHBOURS + WINDOW - 2)
            if size + high - low > 2 * PIECE and batch:
                yield batch
                batch, size = [], 0
            batch.append((i, low, high, a, b))
            size += high - low
    if batch:
        yield batch


def _laid_out(data: list[bytes], batch: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, where each segment begins, whether a window of one segment begins at each byte)."""
    x = np.frombuffer(b"".join(data[i][low:high] for i, low, high, _, _ in batch), np.uint8)
    sizes = np.array([high - low for _, low, high, _, _ in batch])
    begin = np.cumsum(sizes) - sizes
    inside = np.ones(len(x) - WINDOW + 1, bool)
    for e in (begin + sizes)[:-1]:
        inside[e - WINDOW + 1 : e] = False
    return x, begin, inside


def level_counts(data: list[bytes]) -> np.ndarray:
    """Windows per level; every window of every text once."""
    out = np.zeros(LEVELS + 1, np.int64)
    for batch in _segments(data):
        x, begin, _ = _laid_out(data, batch)
        level = window_levels(x)
        for at, (_, low, _, a, b) in zip(begin, batch):
            out += np.bincount(level[at + a - low : at + b - low], minlength=LEVELS + 1)
    return out


def ranks(counts: np.ndarray) -> np.ndarray:
    """Rank of each level: the fewer windows the lower; the higher level first among equals; weak levels last."""
    level = np.arange(LEVELS + 1)
    order = np.lexsort((-level, counts, level < WEAK))
    out = np.empty(LEVELS + 1, np.int64)
    out[order] = level
    return out


def _mixed(words: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row of unsigned 64-bit words."""
    h = np.full(len(words), 0x9E3779B97F4A7C15, np.uint64)
    for i in range(words.shape[1]):
        h = (h ^ words[:, i]) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(32)
    return h


def features(data: list[bytes], rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the chosen features, by text and place. A text shorter than a window is one feature, an empty one none."""
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))]
    far = np.int64(1) << 62
    for batch in _segments(data):
        x, begin, inside = _laid_out(data, batch)
        n = len(inside)
        # the rarest of each run of neighbours, the leftmost among equals; ends of texts see fewer
        key = np.full(n + 2 * (NEIGHBOURS - 1), far)
        key[NEIGHBOURS - 1 : NEIGHBOURS - 1 + n] = np.where(inside, (rank[window_levels(x)] << 32) | np.arange(n), far)
        width = 1
        while width < NEIGHBOURS:
            key = np.minimum(key[:-width], key[width:])
            width *= 2
        votes = np.bincount(key[key < far] & 0xFFFFFFFF, minlength=n)
        chosen = np.flatnonzero(votes >= VOTES)
        segment = np.searchsorted(begin, chosen, side="right") - 1
        text, low, a, b = (np.array([s[j] for s in batch])[segment] for j in (0, 1, 3, 4))
        place = chosen - begin[segment] + low
        ok = (place >= a) & (place < b)
        windows = np.lib.stride_tricks.sliding_window_view(x, WINDOW)[chosen[ok]]
        found.append((text[ok], place[ok], _mixed(np.ascontiguousarray(windows).view("<u8"))))
    short = [i for i, t in enumerate(data) if 0 < len(t) < WINDOW]
    if short:
        padded = np.frombuffer(b"".join(data[i].ljust(WINDOW, b"\0") + len(data[i]).to_bytes(8, "little") for i in short), "<u8")
        found.append((np.array(short), np.zeros(len(short), np.int64), _mixed(padded.reshape(len(short), -1))))
    text, place, value = (np.concatenate(c) for c in zip(*found))
    order = np.lexsort((place, value, text))
    text, place, value = text[order], place[order], value[order]
    once = np.ones(len(text), bool)
    once[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    text, place, value = text[once], place[once], value[once]
    order = np.lexsort((place, text))
    return text[order], value[order]


def fingerprints(data: list[bytes], rank: np.ndarray) -> list[bytes]:
    """The chained filters of each text, one behind the other."""
    text, value = features(data, rank)
    n = np.bincount(text, minlength=len(data))
    filters = -(-n // PER_FILTER)
    first = np.cumsum(filters) - filters
    at = first[text] + (np.arange(len(text)) - (np.cumsum(n) - n)[text]) // PER_FILTER
    bits = np.zeros((int(filters.sum()), BITS), np.uint8)
    for i in range(HASHES):
        bits[at, (value >> np.uint64(12 * i)).astype(np.int64) % BITS] = 1
    packed = np.packbits(bits, axis=1)
    return [packed[f : f + k].tobytes() for f, k in zip(first, filters)]


def likeness(a: bytes, b: bytes) -> float:
    """From 0 (no more in common than by chance) to 1; equal fingerprints have 1, and so has a text that is all in the other."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    one, two = (np.unpackbits(np.frombuffer(x, np.uint8)).reshape(-1, BITS).astype(np.float32) for x in (a, b))
    if (len(one), one.sum(), a) > (len(two), two.sum(), b):
        one, two = two, one
    have, most = one.sum(1), two.sum(1)
    best = np.zeros(len(one))
    for i in range(0, len(one), 512):
        part = have[i : i + 512, None]
        chance = part * most / BITS
        chance = chance + BEYOND * np.sqrt(chance * (1 - part / BITS) * (1 - most / BITS))
        top = np.minimum(part, most)
        common = one[i : i + 512] @ two.T
        with np.errstate(divide="ignore", invalid="ignore"):
            score = np.where(top > chance, (common - chance) / (top - chance), common == np.maximum(part, most))
        best[i : i + 512] = np.clip(score, 0, 1).max(1)
    return float((best * have).sum() / have.sum())


def rarity(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Ranks of the levels over all windows of all texts; a row per level comes to the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(LEVELS + 1, np.int64)
        for batch in batches:
            total += level_counts(_bytes(batch.column("text")))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["level", "n"])

    found = spread(texts(docs, text=text)).mapInArrow(count, "level long, n long").groupBy("level").agg(F.sum("n").alias("n"))
    counts = np.zeros(LEVELS + 1, np.int64)
    for r in found.collect():
        counts[r["level"]] = r["n"]
    return ranks(counts)


def _bytes(column: pa.Array) -> list[bytes]:
    return column.cast(pa.binary()).to_pylist()


def fingerprint(text: Column, rank: np.ndarray) -> Column:
    """Column of fingerprints (binary) of a text column without nulls, under the ranks of ``rarity``."""

    @F.arrow_udf("binary")
    def make(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(fingerprints(_bytes(batch), rank), pa.binary())

    return make(text)


def alike(a: Column, b: Column) -> Column:
    """Column of the likeness of two fingerprint columns without nulls."""

    @F.arrow_udf("double")
    def compare(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for x, y in batches:
            yield pa.array([likeness(p, q) for p, q in zip(x.to_pylist(), y.to_pylist())], pa.float64())

    return compare(a, b)


def _edited(own: str, following: str) -> str:
    half = len(own) // 2
    return own[: len(own) - half] + following[:half]


_RESULT = ["key", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _rows(keys: pa.Array, own: list[str], following: list[str], prints: list[bytes], nexts: list[bytes], rank: np.ndarray) -> list[pa.Array]:
    edited = [_edited(a, b).encode() for a, b in zip(own, following)]
    again = fingerprints(edited, rank)
    return [
        keys, pa.array([len(t) for t in own], pa.int64()), pa.array([sha256(t).hexdigest() for t in edited], pa.string()),
        pa.array(prints, pa.binary()), pa.array(again, pa.binary()),
        pa.array(map(likeness, prints, again), pa.float64()), pa.array(map(likeness, prints, nexts), pa.float64()),
    ]


def spliced(docs: DataFrame, key: str = "doc_id", text: str = "text", rank: np.ndarray | None = None) -> DataFrame:
    """Fingerprints of all texts, of the texts spliced with the next one, and how near both and the next text are.

    Per row: ``key, n_chars, edited_sha256, fingerprint, edited_fingerprint`` (binary), ``near_edited, near_next``. The next
    row is that of the next larger key, the first one after the last; null keys come first, rows of one key go by a hash of
    the text. The edited text has its last half (rounded down, in code points) replaced by as many code points of the next
    text, or all of it. Null texts are empty; empty texts have an empty fingerprint, which is like itself alone; a table of
    one row is its own next. Other columns do not matter; an empty table gives an empty one.

    The texts move once, into ranges of the key; a task goes through its range in order and holds one batch. The first and
    last row of each range are handed on beside the results and meet in a join of one row per range.
    """
    rank = rarity(docs, text) if rank is None else rank
    kind = docs.schema[key].dataType.simpleString()
    base = texts(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), "key")
    keys = ["key", "_h", "_m"]
    ranged = base.select("key", "text", F.xxhash64("text").alias("_h"), F.monotonically_increasing_id().alias("_m"))
    cores = docs.sparkSession.sparkContext.defaultParallelism
    parts = max(cores, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = ranged.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).select("key", "text", F.spark_partition_id().alias("part"))
    ends = ["part", "first", "text"]
    kinds = pa.schema([*zip(_RESULT[1:], [pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64()])])
    tail = pa.schema([("part", pa.int32()), ("first", pa.bool_()), ("text", pa.string())])

    def walk(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def edge(first: bool, keys: pa.Array, t: str, part: int) -> pa.RecordBatch:
            nothing = [pa.nulls(1, f.type) for f in kinds]
            return pa.RecordBatch.from_arrays([keys, *nothing, pa.array([part], pa.int32()), pa.array([first]), pa.array([t])], _RESULT + ends)

        held = None  # the last row so far: its key, text and fingerprint
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, own, part = batch.column("key"), batch.column("text").to_pylist(), batch.column("part")[0].as_py()
            prints = fingerprints([t.encode() for t in own], rank)
            if held is None:
                yield edge(True, keys.slice(0, 1), own[0], part)
            else:
                keys, own, prints = pa.concat_arrays([held[0], keys]), [held[1], *own], [held[2], *prints]
            done = len(own) - 1
            if done:
                out = _rows(keys.slice(0, done), own[:-1], own[1:], prints[:-1], prints[1:], rank)
                yield pa.RecordBatch.from_arrays([*out, *(pa.nulls(done, f.type) for f in tail)], _RESULT + ends)
            held = keys.slice(done, 1), own[-1], prints[-1], part
        if held is not None:
            yield edge(False, held[0], held[1], held[3])

    result = f"key {kind}, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
    walked = stable(ranged.mapInArrow(walk, f"{result}, part int, first boolean, text string"))
    parts = walked.where("first").select("part")
    order = Window.orderBy("part")  # one row per range
    follows = parts.select("part", F.coalesce(F.lead("part").over(order), F.min("part").over(Window.partitionBy())).alias("next"))
    lasts = walked.where("NOT first").select("part", "key", "text").join(follows, "part")
    firsts = walked.where("first").select(F.col("part").alias("next"), F.col("text").alias("following"))

    def finish(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, following = batch.column("text").to_pylist(), batch.column("following").to_pylist()
            prints = fingerprints([t.encode() for t in own + following], rank)
            yield pa.RecordBatch.from_arrays(_rows(batch.column("key"), own, following, prints[: len(own)], prints[len(own) :], rank), _RESULT)

    edges = lasts.join(firsts, "next").select("key", "text", "following").mapInArrow(finish, result)
    both = walked.where("first IS NULL").select(*_RESULT).unionByName(edges)
    return both.withColumnRenamed("key", key)
