"""Exact-size seeded samples."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def seeded_hash(key: str, seed: int) -> Column:
    """52 bits of the md5 of key and seed, as a long: the same number in any SQL engine."""
    text = F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


def sample_exact(df: DataFrame, key: str, fraction: float, seed: int) -> DataFrame:
    """``floor(N * fraction)`` rows chosen by a seeded hash of a unique ``key``.

    The cut-off hash comes from counts per hash prefix (4,096 small rows); only the one prefix at the edge is
    ranked, so no global sort of the rows takes place.
    """
    marked = df.withColumn("__h", seeded_hash(key, seed)).withColumn("__p", F.shiftright("__h", 40))
    sizes = {r["__p"]: r["n"] for r in marked.groupBy("__p").agg(F.count("*").alias("n")).collect()}  # at most 4,096 rows
    total = sum(sizes.values())
    want = math.floor(total * fraction)
    taken, edge = 0, 0
    while edge < 4096 and taken + sizes.get(edge, 0) <= want:
        taken += sizes.get(edge, 0)
        edge += 1
    whole = marked.filter(F.col("__p") < edge)
    rest = marked.filter(F.col("__p") == edge).orderBy("__h", key).limit(want - taken)
    return whole.unionByName(rest).drop("__h", "__p")


def seeded_int(key: str, seed: int, low: int, high: int) -> Column:
    """Deterministic integer in ``[low, high)``."""
    return F.pmod(seeded_hash(key, seed), F.lit(high - low)) + low


def sample_inventory(catalog: DataFrame, key: str, fraction: float = 0.4, seed: int = 137) -> DataFrame:
    """Sampled catalog with a seeded starting stock in [200, 800) and minimum level in [50, 150)."""
    return sample_exact(catalog, key, fraction, seed).withColumns(
        {"current_stock": seeded_int(key, seed + 1, 200, 800), "min_stock_level": seeded_int(key, seed + 2, 50, 150)}
    )
