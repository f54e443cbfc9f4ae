"""Vector columns: cosine, norms and the default hashing embedder."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_WORD = re.compile(r"\w{2,}")


def dot(a: Column, b: Column) -> Column:
    pairs = F.zip_with(a.cast("array<double>"), b.cast("array<double>"), lambda x, y: x * y)
    return F.aggregate(pairs, F.lit(0.0), lambda acc, x: acc + x)


def cosine(a: Column, b: Column, eps: float = 0.0) -> Column:
    """Cosine similarity in double; null where a vector has no length (unless ``eps`` is added to the denominator)."""
    den = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)) + F.lit(eps)
    return F.when(den != 0, dot(a, b) / den)


def hashing_embedder(dim: int = 64):
    """Deterministic batch embedder ``list[str] -> float32 matrix``: word counts by md5 bucket, unit length."""

    def embed(texts: list[str]) -> np.ndarray:
        seen: dict[str, int] = {}
        out = np.zeros((len(texts), dim), dtype=np.float64)
        for i, text in enumerate(texts):
            for word in _WORD.findall((text or "").lower()):
                if word not in seen:
                    seen[word] = int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % dim
                out[i, seen[word]] += 1.0
        norm = np.linalg.norm(out, axis=1, keepdims=True)
        return (out / np.where(norm == 0, 1.0, norm)).astype(np.float32)

    return embed


def embed_column(text: Column, embed) -> Column:
    """Embedding column from a batch function; one call per Arrow batch, the client is made once per task."""

    @F.pandas_udf("array<float>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series(list(np.asarray(embed(s.fillna("").tolist()), dtype=np.float32)))

    return run(text)
