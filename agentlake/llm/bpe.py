"""BPE by a tokenization automaton.

The merges are compiled, one gadget after the other, into a deterministic automaton whose arcs carry tokens and whose
paths are exactly the right tokenizations. A gadget for the merge ``u v -> uv`` copies the state that ``u`` leads to,
takes the arc ``v`` out of the copy, leads ``u`` to the copy, and gives every state that has ``u`` an arc ``uv`` to where
``v`` leads. As all arcs of one token lead to one state, the automaton is kept as

* ``target[token]``: the state the token's arcs lead to;
* the tree of copies, numbered in preorder, so that "was made from" is an interval test;
* per token, the intervals of states that lost it, with the merge's rank.

A token is missing in a state if it was taken out there, or if it was added after the first part of it was taken out.
Encoding runs over the positions of a word: for every prefix there is one path, so each position has one state, and the
next one follows from table lookups. Decoding joins the labels of the arcs.
"""

from __future__ import annotations

import json
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructType

from agentlake.llm.rows import held, texts

#: Words whose ids a worker remembers, in two generations: when the young one is full it becomes the old one.
REMEMBERED = 400_000
#: Prefixes shorter than this keep their state; so many of them, and so many tested arcs, at most.
KNOWN, PREFIXES, ARCS = 7, 100_000, 200_000


def _byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 stands for itself, the others follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(rest)) for b in range(256)]


PUNCTUATION = ".,;:!?#$%&*)"


class Automaton:
    """Compiled from a tokenizer file: vocabulary, merges, word pattern, special tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.vocab: dict[str, int] = dict(model["vocab"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = split["pattern"]["Regex"]
        self.labels = dict((i, t) for t, i in self.vocab.items()) | {i: t for t, i in self.special.items()}
        merges = [tuple(m.split(" ", 1)) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self._compile([(self.vocab[a], self.vocab[b], self.vocab[a + b]) for a, b in merges])
        #: Every end of a token -> its id, -1 where the end is no token itself: what the search at one position walks through.
        self.ends: dict[str, int] = {}
        for t in self.vocab:
            for i in range(len(t.removesuffix(self.suffix)) or 1):
                self.ends.setdefault(t[i:], -1)
        self.ends |= {t: i for t, i in self.vocab.items() if self.target[i] >= 0}

    def _compile(self, merges: list[tuple[int, int, int]]) -> None:
        n = max(self.vocab.values()) + 1
        made = {w for _, _, w in merges}
        self.first = [-1] * n
        self.rank = [-1] * n
        self.target = [-1] * n
        for t in self.vocab.values():
            if t not in made:
                self.target[t] = 0
        parent = [-1]
        lost: list[dict[int, int] | None] = [None] * n  # token -> state that lost it -> rank

        def taken(token: int, state: int) -> int:
            at = lost[token]
            if at:
                low = next(iter(at))  # states are numbered upward, so no ancestor below the first one can be in it
                while state >= low:
                    if state in at:
                        return at[state]
                    state = parent[state]
            return -1

        for rank, (u, v, w) in enumerate(merges):
            at, to = self.target[u], self.target[v]
            if at < 0 or to < 0 or not self._has(at, v, taken):
                continue  # the pair never stands side by side
            parent.append(at)
            new = len(parent) - 1
            if lost[v] is None:
                lost[v] = {}
            lost[v][new] = rank
            self.first[w], self.rank[w], self.target[w] = u, rank, to
            self.target[u] = new
        # preorder numbers of the tree of copies
        children: list[list[int]] = [[] for _ in parent]
        for s in range(1, len(parent)):
            children[parent[s]].append(s)
        begin, end, clock, stack = [0] * len(parent), [0] * len(parent), 0, [(0, False)]
        while stack:
            s, done = stack.pop()
            if done:
                end[s] = clock
                continue
            begin[s] = clock
            clock += 1
            stack.append((s, True))
            stack.extend((c, False) for c in children[s])
        self.target = [begin[s] if s >= 0 else -1 for s in self.target]
        self.lost = {}
        for token, at in enumerate(lost):
            if at:
                rows = sorted((begin[s], end[s], r) for s, r in at.items())
                self.lost[token] = tuple(zip(*rows))
        self.states = len(parent)

    def _has(self, state: int, token: int, taken) -> bool:
        """Whether the state has an arc for the token."""
        if taken(token, state) >= 0:
            return False
        x = token
        while (part := self.first[x]) >= 0:
            # x came with its own rank: it is missing where its first part was taken out no later than that
            if 0 <= taken(part, state) <= self.rank[x]:
                return False
            x = part
        return True

    def taken(self, token: int, state: int) -> int:
        at = self.lost.get(token)
        if at is None:
            return -1
        k = bisect_right(at[0], state) - 1
        return at[2][k] if k >= 0 and state < at[1][k] else -1

    def has(self, state: int, token: int) -> bool:
        return self._has(state, token, self.taken)


class Encoder:
    """Runs texts through an automaton; remembers words and arcs between calls."""

    def __init__(self, automaton: Automaton):
        self.a = automaton
        self.words = _Remembered(self._bytes)
        self.arcs: dict[int, bool] = {}
        self.prefixes: dict[str, tuple[int, int, int]] = {}
        self.letters = _byte_letters()
        self.find = regex.compile(automaton.pattern).findall
        self.split = regex.compile("(" + "|".join(map(regex.escape, automaton.special)) + ")").split if automaton.special else None

    def word(self, word: str) -> list[int]:
        """Ids of one pre-split word."""
        letters, a, seen = self.letters, self.a, self.prefixes
        s = "".join([letters[b] for b in word.encode("utf-8", "replace")])
        n, get, arcs, target = len(s), a.ends.get, self.arcs, a.target
        state, token, back = [0], [-1], [0]
        for j in range(1, n + 1):
            piece = s[:j] if j < n else s + a.suffix
            if j < KNOWN and (step := seen.get(piece)):
                state.append(step[0])
                token.append(step[1])
                back.append(step[2])
                continue
            for i in range(j - 1, -1, -1):
                t = get(piece[i:])
                if t is None:
                    break
                if t < 0:
                    continue
                key = state[i] << 20 | t
                ok = arcs.get(key)
                if ok is None:
                    if len(arcs) > ARCS:
                        arcs.clear()
                    ok = arcs[key] = a.has(state[i], t)
                if ok:
                    state.append(target[t])
                    token.append(t)
                    back.append(i)
                    break
            if j < KNOWN and j < n:
                if len(seen) > PREFIXES:
                    seen.clear()
                seen[piece] = (state[j], token[j], back[j])
        out, j = [], n
        while j:
            out.append(token[j])
            j = back[j]
        return out[::-1]

    def _bytes(self, chunk: str) -> bytes:
        ids = [i for w in self.find(chunk) for i in self.word(w)]
        return pack(f"<{len(ids)}I", *ids)

    def _plain(self, text: str) -> bytes:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            # each letter for itself: a final sigma is no special case
            text = "".join(map(str.lower, text)) if "Σ" in text else text.lower()
        else:
            text = text.lower()
        # any white space parts words and is dropped, so the blank may part them beforehand
        return b"".join(map(self.words.__getitem__, text.replace("\n", " ").split(" ")))

    def __call__(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers; strings of special tokens are those tokens."""
        if len(self.words) > REMEMBERED // 2:
            self.words.age()
        if self.split is None or "<|" not in text:
            return self._plain(text)
        special = self.a.special
        return b"".join(pack("<I", special[p]) if p in special else self._plain(p) for p in self.split(text) if p)

    def decode(self, ids: bytes) -> str:
        """Labels of the arcs, special tokens included, joined by spaces: the file names no decoder."""
        return " ".join(map(self.a.labels.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


class _Remembered(dict):
    def __init__(self, make):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, chunk):
        head = chunk.rstrip(PUNCTUATION)
        if head is not chunk and head[-1:].isalpha():  # no word of the pattern goes on from a letter to a mark
            return self[head] + self[chunk[len(head) :]]
        out = self.old.get(chunk)
        if out is None:
            out = self.make(chunk)
        if len(chunk) < 64:
            self[chunk] = out
        return out

    def age(self):
        self.old = dict(self)
        self.clear()


def _encoder(shared, path: str) -> Encoder:
    return held(path, lambda: Encoder(shared.value))


class Codec:
    """Column functions ``encode`` (text to ids as binary), ``decode`` (ids to text) and ``both`` (text to ids and decoded).

    The automaton is compiled once on the driver and sent to the tasks: its size is that of the vocabulary, whatever the
    data. Null texts give no ids, null ids give an empty text.
    """

    def __init__(self, spark, path: str):
        shared = spark.sparkContext.broadcast(Automaton(path))

        @F.arrow_udf("binary")
        def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            run = _encoder(shared, path)
            for batch in batches:
                yield pa.array([run(t.as_py()) if t.is_valid else b"" for t in batch], pa.binary())

        @F.arrow_udf("string")
        def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            run = _encoder(shared, path)
            for batch in batches:
                yield pa.array([run.decode(t.as_py()) if t.is_valid else "" for t in batch], pa.string())

        @F.arrow_udf(StructType().add("ids", BinaryType()).add("decoded", StringType()))
        def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            run = _encoder(shared, path)
            for batch in batches:
                ids = [run(t.as_py()) if t.is_valid else b"" for t in batch]
                yield pa.StructArray.from_arrays([pa.array(ids, pa.binary()), pa.array(map(run.decode, ids), pa.string())], ["ids", "decoded"])

        # both fields come from one evaluation
        self._encode, self._decode, self._both = encode, decode, both.asNondeterministic()

    def encode(self, text: Column) -> Column:
        return self._encode(text)

    def decode(self, ids: Column) -> Column:
        return self._decode(ids)

    def both(self, text: Column) -> Column:
        return self._both(text)


def encode_documents(docs: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep``, ``ids`` (binary, little-endian unsigned 32-bit) and ``n_tokens`` of every row; no shuffle.

    Rows with a null or empty text get no ids; repeated rows are encoded each; an empty table gives an empty one; columns
    that are not in ``keep`` do not matter, whatever their names.
    """
    codec = Codec(docs.sparkSession, path)
    out = texts(docs, *keep, text=text).select(*keep, codec.encode(F.col("text")).alias("ids"))
    return out.select(*keep, "ids", F.expr("cast(length(ids) div 4 as bigint)").alias("n_tokens"))


def round_trip(docs: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep``, ``ids``, ``n_tokens`` and ``decoded``, the text that the ids give back."""
    codec = Codec(docs.sparkSession, path)
    rows = texts(docs.select(F.struct(*keep).alias("row"), F.col(text).alias("text")), "row")
    out = rows.select("row", codec.both(F.col("text")).alias("x")).select("row", "x.ids", "x.decoded")
    return out.select("row.*", "ids", F.expr("cast(length(ids) div 4 as bigint)").alias("n_tokens"), "decoded")
