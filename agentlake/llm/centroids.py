"""Centroid clustering of integer vectors with geometric drift tightening.

Lloyd's rounds, exact to the last unit. Every vector keeps its cluster, its squared distance to the centroid, and a lower
bound of its distance to all others. When centroids move, a bound is not loosened by the longest move: all vectors of a
cluster lie in one sphere, and how much nearer a moved centroid can come to any point of that sphere follows from the angle
under which the move is seen from it, in the plane through the centre and the move. A vector whose own distance stays
below its loosened bound cannot change its cluster; the others are ambiguous and are compared with every centroid.

What the driver holds is one row per cluster: centroid, sums, number and radius. The vectors go from round to round
through the shared folder, so a lost executor repeats its part of one round only.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agentlake.core import spread, stable

#: Components are this fine; beyond ``LIMIT`` steps, squared distances would not fit a long.
SCALE, LIMIT = 256, 1 << 26

#: Parts into which a centroid's move is cut before its angles are taken.
PIECES = 4

#: Below it, products of components add up exactly in double precision.
EXACT = 1 << 22

#: Room for rounding where distances are compared with bounds.
MARGIN = 1e-9


def integers(df: DataFrame, key: str, vec: str, dim: int) -> DataFrame:
    """``key, v``: the vectors with exactly ``dim`` usable components, as integers."""
    usable = lambda x: x.isNotNull() & (F.abs(x.cast("double")) < LIMIT / SCALE)  # noqa: E731 (nan is larger than any number)
    kept = df.select(F.col(key).alias("key"), F.col(vec).alias("v")).where((F.size("v") == dim) & F.forall("v", usable))
    return kept.select("key", F.transform("v", lambda x: F.floor(x.cast("double") * SCALE)).alias("v"))


def squared(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances, vectors by centroids."""
    if len(v) and max(np.abs(v).max(), np.abs(c).max()) < EXACT:
        x, y = v.astype(np.float64), c.astype(np.float64)
        return ((x * x).sum(1)[:, None] - 2 * (x @ y.T) + (y * y).sum(1)[None, :]).astype(np.int64)
    return (v * v).sum(1)[:, None] - 2 * (v @ c.T) + (c * c).sum(1)[None, :]


def scanned(v: np.ndarray, c: np.ndarray):
    """(cluster, squared distance, distance of the second nearest) against all centroids; ties go to the smaller number."""
    d = squared(v, c)
    at = d.argmin(axis=1)
    rows = np.arange(len(v))
    own = d[rows, at].copy()
    d[rows, at] = np.iinfo(np.int64).max
    second = np.sqrt(d.min(axis=1).astype(np.float64)) if len(c) > 1 else np.full(len(v), np.inf)
    return at.astype(np.int32), own, second


def nearer_by(centre: np.ndarray, radius: float, old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """How much nearer, at most, each moved centroid is to a point of the sphere than it was: bounds of d(x, old) - d(x, new).

    Along the move, the distance from x to the moving point p falls at the rate of the cosine between p - x and the way
    back. For one x that cosine is largest where a piece of the move begins; over the sphere, seen from there as a cone around
    p - centre, it is that of the angle to the cone's nearest ray. Negative results say that the centroid went away.
    """
    back = old - new
    length = np.sqrt((back * back).sum(1))
    total = np.zeros(len(old))
    for i in range(PIECES):
        from_centre = old - back * (i / PIECES) - centre
        away = np.sqrt((from_centre * from_centre).sum(1))
        with np.errstate(divide="ignore", invalid="ignore"):
            cosine = np.clip((from_centre * back).sum(1) / (away * length), -1.0, 1.0)
            angle = np.arccos(cosine) - np.arcsin(np.minimum(1.0, radius / away))
        total += np.where(away > radius, np.cos(np.maximum(0.0, np.nan_to_num(angle))), 1.0) * (length / PIECES)
    return total


def loosening(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """Per cluster, by how much the lower bounds of its vectors may have to fall: the most over all other centroids."""
    a, b = old.astype(np.float64), new.astype(np.float64)
    out = np.zeros(len(old))  # a single cluster has no others
    for i in range(len(old) if len(old) > 1 else 0):
        out[i] = np.delete(nearer_by(a[i], radius[i], a, b), i).max()
    return out


def _columns(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    return batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)


def _state(batch: pa.RecordBatch, *columns: np.ndarray) -> pa.RecordBatch:
    names = ["key", "v", "cluster", "dist", "bound", "scans"]
    return pa.RecordBatch.from_arrays([batch.column("key"), batch.column("v"), *map(pa.array, columns)], names)


def _moved(state: DataFrame, old: np.ndarray, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(new centroids, radii of the clusters around the old ones); sums are made in the tasks, then per cluster."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n, far = np.zeros((len(old), dim), np.int64), np.zeros(len(old), np.int64), np.zeros(len(old), np.int64)
        for batch in batches:
            at = batch.column("cluster").to_numpy()
            v = _columns(batch, dim)
            order = np.argsort(at, kind="stable")
            have, begin = np.unique(at[order], return_index=True)
            if len(have):
                total[have] += np.add.reduceat(v[order], begin, axis=0)
            n += np.bincount(at, minlength=len(old))
            np.maximum.at(far, at, batch.column("dist").to_numpy())
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array(n[some]), pa.array(far[some]), pa.array(list(total[some]), pa.list_(pa.int64()))],
            ["cluster", "n", "far", "total"],
        )

    parts = state.select("v", "cluster", "dist").mapInArrow(sums, "cluster int, n long, far long, total array<long>")
    by_cluster = parts.groupBy("cluster").agg(
        F.sum("n").alias("n"), F.max("far").alias("far"), *[F.sum(F.get("total", F.lit(i))).alias(f"s{i}") for i in range(dim)]
    )
    new, radius = old.copy(), np.zeros(len(old))
    for r in by_cluster.collect():
        new[r["cluster"]] = [r[f"s{i}"] // r["n"] for i in range(dim)]
        radius[r["cluster"]] = np.sqrt(r["far"]) * (1 + MARGIN) + MARGIN
    return new, radius


def cluster(
    df: DataFrame, k: int = 40, rounds: int = 5, dim: int = 64, seed: str = "2:", key: str = "vec_id", vec: str = "embedding",
) -> DataFrame:
    """One row per kept vector: ``key, cluster, distance, cluster_inertia, inertia, centroid_sha256, scans``.

    Kept are vectors with exactly ``dim`` components, none null or not finite, and none of 2 ** 18 or more, whose distances
    would not fit a long. They are taken as integers, ``floor(256 * x)``. The first centroids are the ``k`` vectors whose
    ``seed`` and key have the smallest sha256, fewer where there are fewer vectors; a null key comes last, equal keys go by
    the vector. Rows with a null or repeated key are clustered each; an empty table gives an empty one; other columns do not
    matter. An inertia that does not fit a long is null. ``scans`` counts how often a vector was compared with all
    centroids.
    """
    spark = df.sparkSession
    kind = df.schema[key].dataType.simpleString()
    vectors = integers(df, key, vec, dim)
    order = [F.sha2(F.concat(F.lit(seed), F.col("key").cast("string")), 256).asc_nulls_last(), F.col("v").asc()]
    first = vectors.orderBy(*order).limit(k).select("v").collect()
    centroids = np.array([r["v"] for r in first], dtype=np.int64).reshape(len(first), dim)
    schema = f"key {kind}, v array<long>, cluster int, dist long, bound double, scans int"
    empty = spark.createDataFrame([], f"{key} {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string, scans int")
    if not first:
        return empty

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at, own, bound = scanned(_columns(batch, dim), centroids)
                yield _state(batch, at, own, bound, np.ones(len(at), np.int32))

    state = stable(spread(vectors).mapInArrow(begin, schema))
    for _ in range(rounds):
        moved, radius = _moved(state, centroids, dim)
        state = stable(state.mapInArrow(_again(moved, loosening(centroids, moved, radius), dim), schema))
        centroids = moved
    inertia = state.groupBy("cluster").agg(F.sum(F.col("dist").cast("decimal(38,0)")).alias("d")).collect()
    whole, fits = sum(int(r["d"]) for r in inertia), lambda x: x if x < 1 << 63 else None
    known = [
        (r["cluster"], fits(int(r["d"])), fits(whole), sha256(",".join(map(str, centroids[r["cluster"]].tolist())).encode()).hexdigest())
        for r in inertia
    ]
    # one row per cluster
    by_cluster = F.broadcast(spark.createDataFrame(known, "c int, cluster_inertia long, inertia long, centroid_sha256 string"))
    return state.join(by_cluster, F.col("cluster") == F.col("c")).select(
        F.col("key").alias(key), "cluster", F.col("dist").alias("distance"), "cluster_inertia", "inertia", "centroid_sha256", "scans"
    )


def _again(moved: np.ndarray, loose: np.ndarray, dim: int):
    """One round's step: keep what cannot have changed, scan the rest."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            v, at = _columns(batch, dim), batch.column("cluster").to_numpy().copy()
            away = v - moved[at]
            own = np.einsum("ij,ij->i", away, away)
            bound = batch.column("bound").to_numpy() - loose[at]
            bound = bound - MARGIN * np.abs(np.nan_to_num(bound, posinf=0.0)) - MARGIN
            scans = batch.column("scans").to_numpy().copy()
            open_ = np.flatnonzero(~(np.sqrt(own.astype(np.float64)) * (1 + MARGIN) + MARGIN < bound))
            if len(open_):
                at[open_], own[open_], bound[open_] = scanned(v[open_], moved)
                scans[open_] += 1
            yield _state(batch, at, own, bound, scans)

    return step
