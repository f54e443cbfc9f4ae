"""Secret scan with multipart credential linking.

One pass over the texts finds parts: strong ones that are reported as they stand (the base rule), and weak candidates, such
as short passwords, account names, endpoints, that mean little alone. A credential is an identifier, a secret and the place
where they are used, so a weak candidate is reported only if complementary parts stand in its scope: so many code points on
either side. Parts are joined as intervals: the scope of a candidate and the parts are cut into blocks of text, the blocks
are joined by equality, and overlap is tested inside. A block holds few parts, as parts of a kind do not overlap, so the join
is linear in the text.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

from agentlake.core import fits, stable
from agentlake.llm.rows import texts

#: The base rule: kinds in the order in which spans of one start are listed, with their shortest length. Fixed values.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
SHORTEST = {"assign": 6, "access": 20, "hex": 24}

#: Weak candidates and the role of each in a credential; base kinds have roles too.
ROLES = {
    "assign": "secret", "hex": "secret", "access": "identifier", "weak_access": "identifier", "account": "identifier",
    "weak_secret": "secret", "weak_hex": "secret", "endpoint": "endpoint",
}
#: Spans of one start are listed in this order.
LISTED = (*KINDS, *(k for k in ROLES if k not in KINDS))

WEAK = (
    ("account", re.compile(rb"""\b(?:user(?:name)?|login|account(?:_?id)?|client_?id|access_?key_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]{3,})""", re.IGNORECASE)),
    ("endpoint", re.compile(rb"""\b(?:https?|ftp|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\x00-\x20"'<>]{4,}|\b(?:\d{1,3}\.){3}\d{1,3}(?::\d{2,5})?\b""")),
)

#: Code points between the parts of one credential, at most; and the length of a block of the interval join.
SCOPE, BLOCK = 160, 512

_HEX = bytes(120 if chr(b) in "0123456789abcdef" else 32 for b in range(256))
_WEAK_HEX = re.compile(rb"x{16,}")

SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])


def find_parts(text: str) -> list[tuple[str, int, int]]:
    """Base and weak parts of a text as ``(kind, start, end)`` in code points, end exclusive.

    One byte stands for each code point, so byte offsets are code points; no pattern asks for anything beyond ASCII.
    """
    raw = text.encode("latin-1", "replace")
    base, weak = [], []
    for m in ASSIGN.finditer(raw):
        long = m.end(2) - m.start(2) >= SHORTEST["assign"]
        (base if long else weak).append(("assign" if long else "weak_secret", m.start(), m.end()))
    if b"AKIA" in raw:
        for m in ACCESS.finditer(raw):
            long = m.end() - m.start() >= SHORTEST["access"]
            if long or m.end() - m.start() >= 8:
                (base if long else weak).append(("access" if long else "weak_access", m.start(), m.end()))
    letters = raw.translate(_HEX)
    if b"x" * 16 in letters:
        for m in _WEAK_HEX.finditer(letters):
            long = m.end() - m.start() >= SHORTEST["hex"]
            (base if long else weak).append(("hex" if long else "weak_hex", m.start(), m.end()))
    for kind, pattern in WEAK:
        weak.extend((kind, *m.span()) for m in pattern.finditer(raw))
    order = {k: i for i, k in enumerate(ROLES)}
    base.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    # what overlaps a strong part is that part
    strong: list[list[int]] = []
    for _, begin, end in base:
        if strong and begin <= strong[-1][1]:
            strong[-1][1] = max(strong[-1][1], end)
        else:
            strong.append([begin, end])
    begins = [s[0] for s in strong]

    def apart(begin: int, end: int) -> bool:
        k = bisect_left(begins, end) - 1
        return k < 0 or strong[k][1] <= begin

    return base + sorted((p for p in weak if apart(p[1], p[2])), key=lambda p: (p[1], order[p[0]]))


@F.arrow_udf(ArrayType(StructType().add("kind", StringType()).add("start", IntegerType()).add("end", IntegerType())))
def _parts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        yield pa.array(
            [[dict(zip(("kind", "start", "end"), p)) for p in find_parts(t.as_py())] if t.is_valid else [] for t in batch], pa.list_(SPAN)
        )


#: Not deterministic to the planner, so that a filter on the parts stays above them and a text is scanned once.
_parts = _parts.asNondeterministic()


def _base(parts: Column) -> Column:
    return F.filter(parts, lambda p: p["kind"].isin(*KINDS))


def _key(docs: DataFrame, key: str, text: str) -> list[Column]:
    """Rows of one id and text have the same parts; together the two are the key of the joins."""
    return [F.col(key).alias("doc_key"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_key")]


def _linked(scanned: DataFrame, scope: int) -> DataFrame:
    """``doc_key, text_key, linked``: the weak parts that have complementary parts in their scope."""
    weak = F.filter("parts", lambda p: ~p["kind"].isin(*KINDS))
    # one row of each kind of row, and only where there is something to link
    some = scanned.where((F.size(weak) > 0) & (F.size("parts") > 1)).dropDuplicates(["doc_key", "text_key"])
    role = F.create_map(*[F.lit(x) for kv in ROLES.items() for x in kv])
    part = some.select("doc_key", "text_key", F.explode("parts").alias("p")).select(
        "doc_key", "text_key", "p", role[F.col("p.kind")].alias("role")
    )

    def blocks(begin: Column, end: Column) -> Column:
        return F.explode(F.sequence(F.floor(F.greatest(begin, F.lit(0)) / BLOCK).cast("int"), F.floor((end - 1) / BLOCK).cast("int")))

    asks = part.where(~F.col("p.kind").isin(*KINDS)).select(
        "doc_key", "text_key", "p", "role", blocks(F.col("p.start") - scope, F.col("p.end") + scope).alias("block")
    )
    gives = part.select(
        F.col("doc_key").alias("_k"), F.col("text_key").alias("_t"), F.col("p").alias("_p"), F.col("role").alias("_role"),
        blocks(F.col("p.start"), F.col("p.end")).alias("_block"),
    )
    near = (F.col("_p.start") < F.col("p.end") + scope) & (F.col("p.start") < F.col("_p.end") + scope)
    met = asks.join(
        gives,
        F.col("doc_key").eqNullSafe(F.col("_k")) & (F.col("text_key") == F.col("_t")) & (F.col("block") == F.col("_block"))
        & near & (F.col("role") != F.col("_role")),
    )
    met = met.groupBy("doc_key", "text_key", "p", "role").agg(F.collect_set("_role").alias("roles"))
    has = lambda r: F.array_contains("roles", r)
    full = (
        ((F.col("role") == "identifier") & has("secret"))
        | ((F.col("role") == "secret") & (has("identifier") | has("endpoint")))
        | ((F.col("role") == "endpoint") & has("identifier") & has("secret"))
    )
    return met.where(full).groupBy("doc_key", "text_key").agg(F.collect_list("p").alias("linked"))


def _with_links(rows: DataFrame, scanned: DataFrame, scope: int) -> DataFrame:
    """``rows`` (with ``doc_key, text_key, parts``) and ``spans``: base parts and linked weak ones, in order."""
    links = stable(_linked(scanned, scope))
    right = links.select(F.col("doc_key").alias("_k"), F.col("text_key").alias("_t"), "linked")
    if fits(right, 50_000):
        right = F.broadcast(right)
    out = rows.join(right, F.col("doc_key").eqNullSafe(F.col("_k")) & (F.col("text_key") == F.col("_t")), "left").drop("_k", "_t")
    every = F.concat(_base(F.col("parts")), F.coalesce("linked", F.array().cast("array<struct<kind:string,start:int,end:int>>")))
    ranked = F.transform(every, lambda p: F.struct(
        p["start"].alias("start"), F.array_position(F.lit(list(LISTED)), p["kind"]).alias("rank"), p["end"].alias("end"), p["kind"].alias("kind")
    ))
    plain = F.transform(F.array_sort(ranked), lambda p: F.struct(p["kind"].alias("kind"), p["start"].alias("start"), p["end"].alias("end")))
    return out.withColumn("spans", plain).drop("linked")


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", scope: int = SCOPE) -> DataFrame:
    """``key, base, spans`` of every row: arrays of ``(kind, start, end)``, the base rule's and all reported.

    Texts are read once and not shuffled; what is joined are their parts. Null texts are empty; null ids and repeated rows
    keep their rows; an empty table gives an empty one; columns beside the two named do not matter.
    """
    held = texts(docs.select(F.col(key).alias("doc_key"), F.col(text).alias("text")), "doc_key")
    scanned = stable(held.select(*_key(held, "doc_key", "text"), _parts("text").alias("parts")))
    out = _with_links(scanned, scanned, scope)
    return out.select(F.col("doc_key").alias(key), _base(F.col("parts")).alias("base"), "spans")


def listed(spans: Column) -> Column:
    """Spans as text: ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda p: F.concat_ws(":", p["kind"], p["start"].cast("string"), p["end"].cast("string"))), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda p: p["kind"] == kind)).cast("long")


@F.arrow_udf(StringType())
def _redact(texts_: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for text, spans in texts_:
        out = []
        for t, found in zip(text, spans):
            if not t.is_valid or not found.is_valid or not len(found):
                out.append(t.as_py())
                continue
            t, at, parts = t.as_py(), 0, []
            for s in found.as_py():
                if s["end"] > at:
                    parts += [t[at : max(at, s["start"])], f"[{s['kind'].upper()}]"] if s["start"] >= at else []
                    at = max(at, s["end"])
            out.append("".join([*parts, t[at:]]))
        yield pa.array(out, pa.string())


def redact(docs: DataFrame, key: str = "doc_id", text: str = "text", scope: int = SCOPE) -> DataFrame:
    """``docs`` with every reported span of the text replaced by its kind in brackets; overlapping spans become one.

    Every row and column stays, whatever its name; a text without a span stays as it is, a null one too.
    """
    held = texts(docs.select(F.col(key).alias("doc_key"), F.col(text).alias("text")), "doc_key")
    scanned = stable(held.select(*_key(held, "doc_key", "text"), _parts("text").alias("parts")).where(F.size("parts") > 0))
    small = _with_links(scanned.dropDuplicates(["doc_key", "text_key"]), scanned, scope).where(F.size("spans") > 0)
    small = stable(small.select(F.col("doc_key").alias("_k"), F.col("text_key").alias("_t"), "spans"))
    if fits(small, 50_000):
        small = F.broadcast(small)
    mine, hashed = _key(docs, key, text)
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(key).alias("doc_key"), hashed.alias("text_key"))
    out = rows.join(small, F.col("doc_key").eqNullSafe(F.col("_k")) & (F.col("text_key") == F.col("_t")), "left")
    clean = _redact(F.col("row")[text], F.col("spans"))
    return out.select(*[clean.alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns])
