"""Embedding near-duplicates by a subspace pigeonhole join.

For vectors of length one, cosine >= c means a squared distance of at most 2 - 2c. Rotated and cut into blocks, two such
vectors are within the block's share of that budget in at least one block. Each block is a range join over the cells of
pivots: a vector lives in the cell of its nearest pivot. Between two cells stands the half-way plane; of two partners in
different cells one is within half a radius of it, so a vector also visits the cells whose planes are that near, and the
pair belongs to the cell that the nearer of the two visits. How many pivots a block gets follows from what a sample of the
vectors costs in rows sent and pairs compared; the sample only places pivots, every vector is joined. Cells of many
vectors are cut into slices, and every pair of slices that may hold partners is one task's tile. In a tile the block
distance picks the candidates, and the cosine of the whole vectors in double precision decides. A pair counts in the first
block that lets it pass, so the union of the blocks needs no pair to be written down: a tile hands on, per vector, the
number of its links and the smallest vector it is tied to.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType

from agentlake.core import stable
from agentlake.llm.components import components

#: Numbers of one block; vectors of one slice; rows of a tile that are compared at once.
BLOCK, SLICE, ROWS = 16, 16384, 512

#: Vectors and bytes of the sample that places the pivots; numbers of pivots to choose from; what a row sent costs, in
#: pairs compared.
SAMPLE, SAMPLE_BYTES, PIVOTS, ROW_COST = 8192, 1 << 25, (16, 64, 256, 1024), 8000

#: A place is the block, the pivot and whether the vector visits it, in one number.
PLACES = 1 << 20

#: Added to the budgets, so that rounding loses no candidate; and to the quick test in single precision, which the exact
#: one in double precision follows; and to half a radius.
SLACK, QUICK, EDGE = 1e-7, 1e-4, 1e-6


def rotation(dim: int, seed: int = 7) -> np.ndarray:
    """A fixed random rotation."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def blocks_of(dim: int, block: int = BLOCK) -> list[tuple[int, int]]:
    edges = [*range(0, dim, block), dim]
    return list(zip(edges[:-1], edges[1:]))


class Layout:
    """Blocks, radii and cells for one number of dimensions."""

    def __init__(self, dim: int, cosine: float):
        self.turn, self.blocks = rotation(dim), blocks_of(dim)
        self.budgets = [(2 - 2 * cosine) * (e - b) / dim + SLACK for b, e in self.blocks]

    def turned(self, unit: np.ndarray) -> np.ndarray:
        # row by row in one order, so a vector has the same numbers in every tile
        return np.einsum("ij,jk->ik", unit, self.turn)

    def distance(self, x: np.ndarray, y: np.ndarray, block: int) -> np.ndarray:
        b, e = self.blocks[block]
        d = x[:, b:e] - y[:, b:e]
        return np.einsum("ij,ij->i", d, d)


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of x to those of y."""
    return np.maximum(np.einsum("ij,ij->i", x, x)[:, None] + np.einsum("ij,ij->i", y, y) - 2 * (x @ y.T), 0)


def homes_and_visits(x: np.ndarray, pivots: np.ndarray, budget: float) -> tuple[np.ndarray, np.ndarray]:
    """Nearest pivot of every row, and the pivots whose half-way plane is within half a radius of it."""
    far = _squares(x, pivots)
    home = far.argmin(1)
    apart = np.sqrt(np.maximum(_squares(pivots, pivots), 1e-12))
    visits = far - far[np.arange(len(x)), home][:, None] <= 2 * apart[home] * (np.sqrt(budget) / 2 + EDGE)
    visits[np.arange(len(x)), home] = False
    return home, visits


def place_pivots(x: np.ndarray, budget: float, n: int, slice_rows: int = SLICE) -> np.ndarray:
    """Pivots for a block of n vectors of which x is a sample: of the numbers in PIVOTS the one that costs least."""
    best, least = np.zeros((1, x.shape[1])), np.inf
    for count in [p for p in PIVOTS if p * 8 <= len(x)]:
        pivots = x[:count].copy()
        for _ in range(5):
            home = _squares(x, pivots).argmin(1)
            size = np.bincount(home, minlength=len(pivots))
            total = np.zeros_like(pivots)
            np.add.at(total, home, x)
            pivots = total[size > 0] / size[size > 0][:, None]
        close = np.triu(_squares(pivots, pivots) < 1e-6 * budget, 1).any(0)  # no plane between pivots of one place
        pivots = pivots[~close]
        home, visits = homes_and_visits(x, pivots, budget)
        lives, comes = np.bincount(home, minlength=len(pivots)) * (n / len(x)), visits.sum(0) * (n / len(x))
        parts, more = np.ceil(lives / slice_rows), np.ceil(comes / slice_rows)
        cost = ROW_COST * (lives * (parts + more) + comes * parts).sum() + (lives * (lives / 2 + comes)).sum()
        if cost < least:
            best, least = pivots, cost
    return best


def _units(raw: list[bytes], kind: str) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), dtype=kind).reshape(len(raw), -1).astype(np.float64)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _raw(kind: str):
    @F.arrow_udf(BinaryType())
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = []
            for v in batch:
                x = None
                if v.is_valid and len(v) and v.values.null_count == 0:
                    x = np.asarray(v.values, dtype=kind)
                    square = float(np.dot(x.astype(np.float64), x.astype(np.float64)))
                    x = x if np.isfinite(x).all() and 0 < square < np.inf else None
                out.append(None if x is None else x.tobytes())
            yield pa.array(out, pa.binary())

    return run


def _roots(n: int, a: np.ndarray, b: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Smallest id tied to each of n nodes by the edges (a, b)."""
    low = ids.copy()
    while True:
        new = low.copy()
        np.minimum.at(new, a, low[b])
        np.minimum.at(new, b, low[a])
        if (new == low).all():
            return low
        low = new


def _lead(x: np.ndarray, own: np.ndarray, other: np.ndarray) -> np.ndarray:
    """By how much each row is nearer to one pivot than to the other, in squares: grows with the way to their plane."""
    far, near = x - other, x - own
    return np.einsum("ij,ij->i", far, far) - np.einsum("ij,ij->i", near, near)


def _tile(layout: Layout, block: int, cosine: float, same: bool, left: tuple, right: tuple, visit: tuple | None = None) -> pd.DataFrame:
    """Links between two sides (or within one): per vector their number, weighted by copies, and the smallest vector tied.

    ``visit``: pivots of the block, this cell's pivot, and the home pivots of the left side, which visits. A pair counts
    here if the visitor is nearer to the half-way plane than the other, or as near and of the smaller pivot.
    """
    (ids1, n1, u1), (ids2, n2, u2) = left, right
    t1, t2 = layout.turned(u1), layout.turned(u2)
    b, e = layout.blocks[block]
    budget = layout.budgets[block]

    def padded(t: np.ndarray, mine: int) -> np.ndarray:
        # with half the square in front of a one, and the reverse on the other side, a product is minus half a distance
        x = t[:, b:e]
        half = -0.5 * np.einsum("ij,ij->i", x, x)[:, None]
        more = [half, np.ones_like(half)]
        return np.concatenate([x, *(more if mine else more[::-1])], axis=1).astype(np.float32)

    p1, p2 = padded(t1, 1), np.ascontiguousarray(padded(t2, 0).T)
    least = np.float32(-0.5 * (budget + QUICK))
    count1, count2 = np.zeros(len(ids1), np.int64), np.zeros(len(ids2), np.int64)
    edges = []
    for at in range(0, len(ids1), ROWS):
        to = min(at + ROWS, len(ids1))
        near = p1[at:to] @ p2 >= least
        if same:
            near[:, : at + 1] = False
            near[:, at:to] &= np.tri(to - at, dtype=bool).T ^ np.eye(to - at, dtype=bool)
        i, j = np.divmod(np.flatnonzero(near), len(ids2))
        for part in range(0, len(i), 200_000):
            x, y = i[part : part + 200_000] + at, j[part : part + 200_000]
            ok = np.einsum("ij,ij->i", u1[x], u2[y]) >= cosine
            x, y = x[ok], y[ok]
            first = layout.distance(t1[x], t2[y], block) <= budget
            for k in range(block):
                first &= layout.distance(t1[x], t2[y], k) > layout.budgets[k]
            x, y = x[first], y[first]
            if visit:
                pivots, here, home = visit
                p, q = pivots[home[x]], np.broadcast_to(pivots[here], (len(x), e - b))
                mine, other = _lead(t1[x, b:e], p, q), _lead(t2[y, b:e], q, p)
                first = (mine < other) | ((mine == other) & (home[x] < here))
                x, y = x[first], y[first]
            np.add.at(count1, x, n2[y])
            np.add.at(count2, y, n1[x])
            if len(x):
                edges.append((x, y))
    if not edges:
        return pd.DataFrame({"id": pd.Series(dtype="int64"), "n": pd.Series(dtype="int64"), "root": pd.Series(dtype="int64")})
    x, y = (np.concatenate(z) for z in zip(*edges))
    ids, shift = (ids1, 0) if same else (np.concatenate([ids1, ids2]), len(ids1))
    root = _roots(len(ids), x, y + shift, ids)
    count = count1 + count2 if same else np.concatenate([count1, count2])
    some = count > 0
    return pd.DataFrame({"id": ids[some], "n": count[some], "root": root[some]})


def _plan(usable: DataFrame, width: int, kind: str, cosine: float, slice_rows: int) -> dict[tuple[int, int], np.ndarray]:
    """Pivots per dimension and block, from at most SAMPLE vectors or SAMPLE_BYTES, chosen by a hash of their bytes."""
    n, size = usable.agg(F.count(F.lit(1)), F.sum(F.length("raw"))).first()
    share = min(1.0, SAMPLE / max(n, 1), SAMPLE_BYTES / max(size or 0, 1))
    chosen = usable.select("raw").where(F.pmod(F.xxhash64("raw"), F.lit(1 << 30)) < int(share * (1 << 30)))
    by_dim: dict[int, list[bytes]] = {}
    for (raw,) in chosen.distinct().orderBy(F.xxhash64("raw"), "raw").collect():
        by_dim.setdefault(len(raw) // width, []).append(bytes(raw))
    plan = {}
    for dim, raws in by_dim.items():
        layout = Layout(dim, cosine)
        turned = layout.turned(_units(raws, kind))
        for block, (b, e) in enumerate(layout.blocks):
            plan[dim, block] = place_pivots(turned[:, b:e], layout.budgets[block], int(len(raws) / share), slice_rows)
    return plan


def _pivots(plan: dict, dim: int, block: int, width: int) -> np.ndarray:
    found = plan.get((dim, block))
    return np.zeros((1, width)) if found is None else found  # vectors of a rare dimension share one cell


def near_duplicates(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = 0.9, slice_rows: int = SLICE) -> DataFrame:
    """``key, n_links, component_id, kept`` of every row.

    Vectors that are null, empty, zero or hold null or non-finite numbers, and rows with a null key, link with nothing; nor
    do vectors of different dimensions. Copies of a vector are one class in the join and count each. Several rows of one key
    are one node of the components. An empty table gives an empty one; other columns do not matter.
    """
    spark = vectors.sparkSession
    double = isinstance(vectors.schema[vector].dataType.elementType, DoubleType)
    kind = "<f8" if double else "<f4"
    width = 8 if double else 4
    rows = stable(vectors.select(F.col(key).cast("long").alias("key"), _raw(kind)(F.col(vector)).alias("raw")))
    usable = rows.where(F.col("raw").isNotNull() & F.col("key").isNotNull())
    pivots = spark.sparkContext.broadcast(_plan(usable, width, kind, cosine, slice_rows))
    classes = usable.groupBy("raw").agg(F.min("key").alias("id"), F.count(F.lit(1)).alias("n"))
    classes = classes.withColumn("dim", (F.length("raw") / width).cast("int"))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        layouts: dict[int, Layout] = {}
        for pdf in batches:
            for dim, part in pdf.groupby("dim"):
                layout = layouts.setdefault(dim, Layout(dim, cosine))
                for at in range(0, len(part), 1000):
                    some = part.iloc[at : at + 1000]
                    turned = layout.turned(_units(some["raw"].tolist(), kind))
                    homes, places = [], [[] for _ in range(len(some))]
                    for block, (b, e) in enumerate(layout.blocks):
                        home, visits = homes_and_visits(turned[:, b:e], _pivots(pivots.value, dim, block, e - b), layout.budgets[block])
                        homes.append(home)
                        for row, cell in enumerate(home.tolist()):
                            places[row].append((block * PLACES + cell) * 2)
                        for row, cell in np.argwhere(visits).tolist():
                            places[row].append((block * PLACES + cell) * 2 + 1)
                    yield some[["raw", "id", "n", "dim"]].assign(homes=np.stack(homes, axis=1).tolist(), places=places)

    classes = stable(classes.mapInPandas(place, "raw binary, id long, n long, dim int, homes array<int>, places array<long>"))
    spots = classes.select("raw", "id", "n", "dim", "homes", F.explode("places").alias("place"))
    spots = spots.select(
        "raw", "id", "n", "dim", "homes", F.shiftright("place", 1).alias("cell"), (F.col("place") % 2).cast("int").alias("next")
    )
    # one row per dimension, block and pivot, of which there are at most PIVOTS[-1], however many vectors
    parts = lambda next: F.ceil(F.count(F.when(F.col("next") == next, 1)) / slice_rows).cast("int")
    sizes = stable(spots.groupBy("dim", "cell").agg(parts(0).alias("parts"), parts(1).alias("more")))

    def each(count: str, *fields) -> F.Column:
        one = lambda k: F.struct(*(f(k).cast("int").alias(name) for name, f in zip(("next", "i", "j", "side"), fields)))
        none = F.array().cast("array<struct<next:int,i:int,j:int,side:int>>")
        return F.when(F.col(count) > 0, F.transform(F.sequence(F.lit(0), F.col(count) - 1), one)).otherwise(none)

    mine, fixed = F.col("mine"), lambda k: lambda _: F.lit(k)
    within = each("parts", fixed(0), lambda k: F.least(mine, k), lambda k: F.greatest(mine, k), lambda k: mine > k)
    hosts = each("more", fixed(1), lambda k: k, lambda _: mine, fixed(1))
    visits = each("parts", fixed(1), lambda _: mine, lambda k: k, fixed(0))
    spread = (
        spots.join(F.broadcast(sizes), ["dim", "cell"])
        .withColumn("mine", F.pmod(F.xxhash64("id"), F.when(F.col("next") == 0, F.col("parts")).otherwise(F.col("more"))).cast("int"))
        .withColumn("to", F.explode(F.when(F.col("next") == 0, F.concat(within, hosts)).otherwise(visits)))
        .select("raw", "id", "n", "dim", "cell", F.get("homes", F.floor(F.col("cell") / PLACES).cast("int")).alias("home"), "to.*")
    )

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        dim, (block, here) = int(pdf["dim"].iloc[0]), divmod(int(pdf["cell"].iloc[0]), PLACES)
        layout, sides, visit = Layout(dim, cosine), [], None
        for k in (0, 1):
            part = pdf[pdf["side"] == k].sort_values("id", kind="stable")
            sides.append((part["id"].to_numpy(), part["n"].to_numpy(), _units(part["raw"].tolist(), kind) if len(part) else np.zeros((0, dim))))
            if k == 0 and pdf["next"].iloc[0] == 1:
                b, e = layout.blocks[block]
                visit = (_pivots(pivots.value, dim, block, e - b), here, part["home"].to_numpy())
        same = visit is None and pdf["i"].iloc[0] == pdf["j"].iloc[0]
        return _tile(layout, block, cosine, same, sides[0], sides[0] if same else sides[1], visit)

    met = stable(spread.groupBy("dim", "cell", "next", "i", "j").applyInPandas(join, "id long, n long, root long"))
    per = met.groupBy("id").agg(F.sum("n").alias("partners"))
    group = components(met.select(F.col("id").alias("a"), F.col("root").alias("b")))
    per = classes.join(per, "id", "left").join(group, F.col("id") == F.col("node"), "left").select(
        F.col("raw").alias("_raw"), (F.coalesce("partners", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("label", "id").alias("component_id")
    )
    out = rows.join(per, (F.col("raw") == F.col("_raw")) & F.col("key").isNotNull(), "left")
    component = F.coalesce("component_id", "key")
    return out.select(
        F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("key").eqNullSafe(component).alias("kept"),
    )
