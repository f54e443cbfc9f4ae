"""Text columns: whitespace, truncation, fences, tags, templates, verdicts, JSON checks, chunking."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS_AT_ONCE, CHARS_AT_ONCE = 256, 1 << 21  # texts and characters of chunks that a task holds as Python objects


def collapse_spaces(text: Column) -> Column:
    """Runs of spaces and tabs to one space; outer white space removed."""
    return F.regexp_replace(F.regexp_replace(text, r"[ \t]+", " "), r"^\s+|\s+$", "")


def truncate(text: Column, most: int, mark: str = "...") -> Column:
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most), F.lit(mark))).otherwise(text)


def strip_fences(text: Column) -> Column:
    """Code-fence lines removed and outer white space trimmed."""
    bare = F.regexp_replace(text, r"(?m)^\s*```[A-Za-z0-9_]*\s*$", "")
    return F.regexp_replace(bare, r"^\s+|\s+$", "")


def outer_object(text: Column) -> Column:
    """From the first ``{`` to the last ``}``, or ``''``."""
    return F.regexp_extract(strip_fences(text), r"(?s)(\{.*\})", 1)


def extract_tag(text: Column, tag: str) -> Column:
    """Content of the first ``<tag>...</tag>`` or ``''``."""
    return F.regexp_extract(text, rf"(?s)<{tag}>(.*?)</{tag}>", 1)


def extract_tags(text: Column, tag: str) -> Column:
    """Contents of all ``<tag>...</tag>`` blocks, in order."""
    return F.regexp_extract_all(text, F.lit(rf"(?s)<{tag}>(.*?)</{tag}>"), F.lit(1))


def parse_tasks(text: Column) -> Column:
    """Task blocks to structs (type, description); blocks without a description are left out."""
    blocks = F.transform(
        extract_tags(text, "task"),
        lambda b: F.struct(
            F.trim(F.regexp_extract(b, r"(?s)<type>(.*?)</type>", 1)).alias("type"),
            F.trim(F.regexp_extract(b, r"(?s)<description>(.*?)</description>", 1)).alias("description"),
        ),
    )
    return F.filter(blocks, lambda t: t["description"] != "")


def lines_of(text: Column) -> Column:
    """Non-empty trimmed lines."""
    return F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda x: x != "")


def template(pattern: str, columns: Mapping[str, Column]) -> Column:
    """``"[{a}] {b}"`` with named columns as one string column; nulls become empty text."""
    parts = []
    for piece in re.split(r"(\{\w+\})", pattern):
        name = piece[1:-1] if piece.startswith("{") and piece.endswith("}") else None
        if name in columns:
            parts.append(F.coalesce(columns[name].cast("string"), F.lit("")))
        elif piece:
            parts.append(F.lit(piece))
    return F.concat(*parts)


def verdict(answer: Column, yes: Sequence[str], no: Sequence[str]) -> Column:
    """True or false by whole tokens, longest first; null where the answer has none of them."""
    token = lambda words: "(?i)(?<![A-Za-z0-9_])(" + "|".join(map(re.escape, sorted(words, key=len, reverse=True))) + ")(?![A-Za-z0-9_])"
    return F.when(F.rlike(answer, F.lit(token(no))), False).when(F.rlike(answer, F.lit(token(yes))), True)


def valid_json(text: Column) -> Column:
    """True where the text parses as a JSON value."""
    return F.coalesce(F.try_parse_json(text).isNotNull(), F.lit(False))


def extract_id(text: Column, prefix: str, digits: int) -> Column:
    """First record id like ``CLM-123456`` or ``''``."""
    return F.regexp_extract(text, rf"{prefix}-\d{{{digits}}}", 0)


def cut_points(text: str, size: int, overlap: int, min_cut: int, separator: str = "\n") -> Iterator[tuple[int, int]]:
    """(start, end) of the chunks of one text: windows of ``size`` ending after the last separator in them.

    A cut that leaves under ``min_cut`` characters is not taken; the next window starts ``overlap`` before the end,
    or at the end where that would not move forward.
    """
    total = len(text)
    if total <= size:
        yield 0, total
        return
    start = 0
    while start < total:
        end = min(start + size, total)
        brk = text.rfind(separator, start, end)
        if brk >= 0 and brk + len(separator) - start >= min_cut:
            end = brk + len(separator)
        yield start, end
        if end >= total:
            return
        start = end - overlap if end - overlap > start else end


def chunk_text(
    docs: DataFrame, id_col: str, text: str, size: int = 2000, overlap: int = 100, min_cut: int = 50,
    max_chunks: int | None = None, strip: bool = False,
) -> DataFrame:
    """Overlapping newline-aware chunks: (id, chunk_id, text, chunk_size). Documents are cut in parallel, whole.

    With ``strip`` chunks are trimmed, empty ones dropped and numbered anew; ``max_chunks`` keeps the first ones.
    """
    if overlap >= size:
        raise ValueError("overlap must be smaller than size")
    clean = docs.select(F.col(id_col), collapse_spaces(F.col(text)).alias("__text"))
    kind = docs.schema[id_col].dataType.simpleString()

    def cut(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(low, ROWS_AT_ONCE)
                ids, numbers, texts, held = [], [], [], 0
                for at, body in enumerate(part.column("__text")):
                    body = body.as_py()
                    if body is None:
                        continue
                    n = 0
                    for a, b in cut_points(body, size, overlap, min_cut):
                        piece = body[a:b].strip() if strip else body[a:b]
                        if strip and not piece:
                            continue
                        if max_chunks is not None and n >= max_chunks:
                            break
                        ids.append(at)
                        numbers.append(n)
                        texts.append(piece)
                        n += 1
                        held += len(piece)
                        if held >= CHARS_AT_ONCE:
                            yield made(part, ids, numbers, texts)
                            ids, numbers, texts, held = [], [], [], 0
                if ids:
                    yield made(part, ids, numbers, texts)

    def made(part, ids, numbers, texts):
        columns = [part.column(id_col).take(pa.array(ids, pa.int64())), pa.array(numbers, pa.int64()), pa.array(texts, pa.string())]
        return pa.RecordBatch.from_arrays([*columns, pa.array([len(t) for t in texts], pa.int64())], [id_col, "chunk_id", "text", "chunk_size"])

    return clean.mapInArrow(cut, f"{id_col} {kind}, chunk_id long, text string, chunk_size long")


def chunk_counts(
    docs: DataFrame, id_col: str, text: str, size: int = 2000, overlap: int = 100, min_cut: int = 50,
    max_chunks: int | None = None, strip: bool = False,
) -> DataFrame:
    """(id, n_seen, n_dropped) of each id with chunks: how many ``chunk_text`` finds, and how many ``max_chunks`` leaves out."""
    chunks = chunk_text(docs, id_col, text, size, overlap, min_cut, strip=strip)
    # chunks are numbered in each row, so that the bound holds for rows, not for ids
    dropped = F.count_if(F.col("chunk_id") >= max_chunks) if max_chunks is not None else F.lit(0).cast("long")
    return chunks.groupBy(id_col).agg(F.count(F.lit(1)).alias("n_seen"), dropped.alias("n_dropped"))
