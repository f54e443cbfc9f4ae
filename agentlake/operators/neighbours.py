"""Exact and approximate nearest neighbours.

Queries within a checked bound travel to the corpus: every task scores its batches against the query matrix and
hands on at most k rows per query and batch. Beyond the bound, the corpus is cut into cells around pivots; a query visits
its own cell first, and then only cells that can still beat its k-th score. Tiles of a cell and its queries meet by an
equi-join, and again only k rows per query leave a tile. No plan emits all pairs.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from agentlake.core import stable
from agentlake.operators.predicates import compile_where, compile_where_document

MAX_CARRIED = 2048  # queries carried to every task: 2,048 x 64 floats are half a megabyte
CORPUS_BLOCK, QUERY_BLOCK = 32_768, 32_768
QUERIES_A_TILE = 32_768
ROWS_A_CELL, MOST_CELLS = 16_384, 1024  # a tile is cheap to score: few large cells move fewer rows than many small ones
CELLS = 1 << 21  # scores held at once in a task
FIRST_ROWS, SCREEN_ROWS, SCREEN_QUERIES = 512, 4096, 1024  # single-precision products held at once
DIGITS = 9  # scores are compared after rounding, so equal vectors tie and the smaller id wins


def _stack(vecs: list, dim: int | None = None) -> np.ndarray:
    """Vectors as a matrix; a null vector becomes a row of nan, which no metric gives a score."""
    dim = dim or next((len(v) for v in vecs if v is not None), 1)
    return np.array([np.full(dim, np.nan) if v is None else v for v in vecs], dtype=np.float64).reshape(len(vecs), dim)


def _scores(corpus: np.ndarray, queries: np.ndarray, metric: str) -> np.ndarray:
    """Matrix corpus x queries, larger is better; nan where a cosine is not defined."""
    c, q = corpus.astype(np.float64), queries.astype(np.float64)
    if metric == "l2":
        return -np.round((c * c).sum(1)[:, None] - 2 * c @ q.T + (q * q).sum(1)[None, :], DIGITS)
    nc, nq = np.linalg.norm(c, axis=1), np.linalg.norm(q, axis=1)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.round((c @ q.T) / (nc[:, None] * nq[None, :]), DIGITS)


def _keep(q: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int):
    """First k entries per query position: score descending, id ascending, undefined last."""
    order = np.lexsort((ids, -np.where(np.isnan(scores), -np.inf, scores), q))
    q, ids, scores = q[order], ids[order], scores[order]
    first = np.searchsorted(q, q, side="left")
    ok = np.arange(len(q)) - first < k
    return q[ok], ids[ok], scores[ok]


def _best(vecs: np.ndarray, ids: np.ndarray, queries: np.ndarray, k: int, metric: str):
    """(query position, id, score) of the k best rows per query, in bounded memory."""
    if len(vecs) <= FIRST_ROWS or not len(queries):
        return _best_of_all(vecs, ids, queries, k, metric)
    size, asked = np.linalg.norm(vecs, axis=1), np.linalg.norm(queries, axis=1)
    if metric == "l2":
        known, sound, odd = ~np.isnan(size), ~np.isnan(asked), np.isinf(size).any() or np.isinf(asked).any()
    else:
        known, sound = size > 0, asked > 0
        odd = any((np.isinf(n) | ((n == 0) & (x != 0).any(axis=1))).any() for n, x in ((size, vecs), (asked, queries)))
    if odd:
        return _best_of_all(vecs, ids, queries, k, metric)
    # rows without a score come last, the smaller id first: k of them are enough
    blank = np.flatnonzero(~known)
    blank = blank[np.argsort(ids[blank], kind="stable")[:k]]
    first = np.argsort(ids, kind="stable")[:k]
    at, rest = np.flatnonzero(sound), np.flatnonzero(~sound)
    found = _screened(vecs[known], ids[known], queries[at], k, metric)
    parts = [(at[found[0]], found[1], found[2])]
    for some, rows in ((at, blank), (rest, first)):
        if len(some) and len(rows):
            q = np.repeat(some, len(rows))
            parts.append((q, np.tile(ids[rows], len(some)), np.full(len(q), np.nan)))
    return _keep(*[np.concatenate(x) for x in zip(*parts)], k)


def _best_of_all(vecs: np.ndarray, ids: np.ndarray, queries: np.ndarray, k: int, metric: str):
    """As ``_best``, every row scored in double precision."""
    step = max(k, CELLS // max(1, len(queries)))
    found = []
    for low in range(0, len(vecs), step):
        s = _scores(vecs[low : low + step], queries, metric)
        flat = np.where(np.isnan(s), -np.inf, s)
        n = len(flat)
        floor = np.partition(flat, n - k, axis=0)[n - k] if n > k else np.full(flat.shape[1], -np.inf)
        row, col = np.nonzero(flat >= floor[None, :])
        found.append(_keep(col, ids[low : low + step][row], s[row, col], k))
    if len(found) == 1:
        return found[0]
    return _keep(*[np.concatenate(x) for x in zip(*found)], k)


def _few_copies(vecs: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the rows without those of which k equal ones with smaller ids are there: they are never among the k best."""
    rows = np.ascontiguousarray(vecs).view(np.dtype((np.void, vecs.itemsize * vecs.shape[1]))).ravel()
    same = np.unique(rows, return_inverse=True)[1].ravel()
    order = np.lexsort((np.argsort(np.argsort(ids, kind="stable")), same))
    kind = same[order]
    return np.sort(order[np.arange(len(kind)) - np.searchsorted(kind, kind) < k])


def _screened(vecs: np.ndarray, ids: np.ndarray, queries: np.ndarray, k: int, metric: str):
    """As ``_best`` for rows and queries with a score: products in single precision rule out all rows but those that may be
    among the k best within the error of such a product, and these are scored in double precision."""
    kept = _few_copies(vecs, ids, k) if len(vecs) else np.arange(0)
    c, ids, q = vecs[kept].astype(np.float64), ids[kept], queries.astype(np.float64)
    n, dim = c.shape
    none = np.zeros(0, np.int64)
    if not n or not len(q):
        return none, ids[:0], np.zeros(0)
    cc, qq = (c * c).sum(axis=1), (q * q).sum(axis=1)
    if metric == "l2":  # order by 2cq - cc
        left, right = np.hstack([2 * c, -cc[:, None]]), np.hstack([q, np.ones((len(q), 1))])
    else:
        left, right = c / np.sqrt(cc)[:, None], q / np.sqrt(qq)[:, None]
    slack = (dim + 10) * 2.0**-22 * np.linalg.norm(left, axis=1).max() * np.linalg.norm(right, axis=1) + 4 * 10.0**-DIGITS
    with np.errstate(over="ignore"):
        left, right = left.astype(np.float32), right.astype(np.float32)
    if not (np.isfinite(left).all() and np.isfinite(right).all()):
        return _best_of_all(c, ids, q, k, metric)
    found = []
    for low in range(0, len(q), SCREEN_QUERIES):
        some, room = right[low : low + SCREEN_QUERIES], slack[low : low + SCREEN_QUERIES]
        floor = np.full(len(some), -np.inf)
        at_q, at_row, at_s = none, none, np.zeros(0, np.float32)
        start, width = 0, max(FIRST_ROWS, k)
        while start < n and len(at_q) <= CELLS:
            s = some @ left[start : start + width].T
            wide = s.shape[1]
            if not start and wide > k:
                floor = np.partition(s, wide - k, axis=1)[:, wide - k].astype(np.float64)
            # never above the bound that the rows are held against below
            hit = np.flatnonzero(s >= np.nextafter((floor - room).astype(np.float32), np.float32(-np.inf))[:, None])
            at_q, at_row = np.concatenate([at_q, hit // wide]), np.concatenate([at_row, start + hit % wide])
            at_s = np.concatenate([at_s, s.ravel()[hit]])
            order = np.lexsort((-at_s, at_q))
            at_q, at_row, at_s = at_q[order], at_row[order], at_s[order]
            kth = np.flatnonzero(np.arange(len(at_q)) - np.searchsorted(at_q, at_q) == k - 1)
            floor[at_q[kth]] = at_s[kth]
            may = at_s >= (floor - room)[at_q]
            at_q, at_row, at_s = at_q[may], at_row[may], at_s[may]
            start, width = start + width, SCREEN_ROWS
        if start < n:  # too many rows are as near as another: no ruling out
            col, near, score = _best_of_all(c, ids, q[low : low + SCREEN_QUERIES], k, metric)
            found.append((low + col, near, score))
            continue
        score = np.empty(len(at_q))
        for part in range(0, len(at_q), 1 << 16):
            i, j = at_row[part : part + (1 << 16)], low + at_q[part : part + (1 << 16)]
            dot = np.einsum("ij,ij->i", c[i], q[j])
            exact = -np.round(cc[i] - 2 * dot + qq[j], DIGITS) if metric == "l2" else np.round(dot / (np.sqrt(cc[i]) * np.sqrt(qq[j])), DIGITS)
            score[part : part + (1 << 16)] = exact
        found.append(_keep(low + at_q, ids[at_row], score, k))
    return tuple(np.concatenate(x) for x in zip(*found))


def _merge(local: DataFrame, k: int, metric: str) -> DataFrame:
    score = F.col("score")
    shown = F.when(F.isnan(score), None).otherwise(-score if metric == "l2" else score)
    w = Window.partitionBy("query_id").orderBy(F.when(~F.isnan(score), score).desc_nulls_last(), F.asc("id"))
    ranked = local.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "id", shown.alias("distance" if metric == "l2" else "score"))


def _carried(corpus: DataFrame, rows: list, k: int, metric: str, schema: str) -> DataFrame:
    """``rows``: the queries themselves, already within the caller's bound."""
    names = [r["query_id"] for r in rows]
    known = next((len(r["vec"]) for r in rows if r["vec"] is not None), None)

    def score(batches):
        for pdf in batches:
            if len(pdf):
                vecs = _stack(pdf["vec"].to_list(), known)
                col, ids, s = _best(vecs, pdf["id"].to_numpy(), _stack([r["vec"] for r in rows], vecs.shape[1]), k, metric)
                yield pd.DataFrame({"query_id": [names[c] for c in col], "id": ids, "score": s})

    rows = [{"vec": r["vec"]} for r in rows]
    return corpus.mapInPandas(score, schema)


def _meet(k: int, metric: str):
    """Tile of a corpus block and a query block: at most k rows per query."""

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"query_id": [], "id": [], "score": []})
        dim = next((len(v) for side in (left, right) for v in side["vec"] if v is not None), 1)
        asked = _stack(right["vec"].to_list(), dim)
        col, ids, s = _best(_stack(left["vec"].to_list(), dim), left["id"].to_numpy(), asked, k, metric)
        return pd.DataFrame({"query_id": right["query_id"].to_numpy()[col], "id": ids, "score": s})

    return meet


def _tiles(corpus: DataFrame, queries: DataFrame, k: int, metric: str, schema: str, group: str, query_block: int = QUERY_BLOCK) -> DataFrame:
    """Rows of equal ``group`` meet, in tiles of about CORPUS_BLOCK by ``query_block`` rows."""
    g = group
    blocks = lambda rows: F.ceil(F.count("*") / rows).cast("int")
    cuts = corpus.groupBy(g).agg(blocks(CORPUS_BLOCK).alias("__nc")).join(queries.groupBy(g).agg(blocks(query_block).alias("__nq")), g)

    def spread(df, key, own, other, own_block, other_block):
        mine = F.pmod(F.xxhash64(F.col(key)), F.col(own)).cast("int")
        both = df.join(cuts, g).withColumn(own_block, mine).withColumn(
            other_block, F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        )
        # fresh column identities: both sides may come from one table
        return both.select(*[F.col(x).alias(x) for x in (key, "vec", g, "__qb", "__cb")])

    c = spread(corpus, "id", "__nc", "__nq", "__cb", "__qb")
    q = spread(queries, "query_id", "__nq", "__nc", "__qb", "__cb")
    on = [g, "__qb", "__cb"]
    return c.groupBy(*on).cogroup(q.groupBy(*on)).applyInPandas(_meet(k, metric), schema)


class _Pivots:
    """Cells around chosen corpus vectors and what the distances to them rule out.

    Distances are those of the space in which the metric is one: unit vectors for the cosine, the vectors themselves for l2.
    """

    def __init__(self, points: list, metric: str):
        self.metric = metric
        self.at = self.placed(_stack(points))
        self.rows = np.zeros(len(self.at))
        self.radius = np.zeros(len(self.at))
        self.apart = self.distances(self.at)

    def placed(self, x: np.ndarray) -> np.ndarray:
        return x if self.metric == "l2" else x / np.linalg.norm(x, axis=1)[:, None]

    def distances(self, x: np.ndarray) -> np.ndarray:
        d = (x * x).sum(1)[:, None] - 2 * x @ self.at.T + (self.at * self.at).sum(1)[None, :]
        return np.sqrt(np.maximum(d, 0))

    def visited(self, vecs: list, best: np.ndarray, home: np.ndarray) -> list:
        """Per query, the cells beside ``home`` that may hold a row as good as ``best``, its k-th score so far (nan: none)."""
        x = self.placed(_stack(vecs, self.at.shape[1]))
        d = self.distances(x)
        farthest = -best if self.metric == "l2" else 2 - 2 * best  # squared
        size = np.sqrt((x * x).sum(1))[:, None] + np.sqrt((self.at * self.at).sum(1))[None, :] + self.radius[None, :]
        # scores tie after rounding; distances carry the rounding of doubles
        slack = 1e-8 + 1e-12 * size * size
        low = np.maximum(0.0, d - self.radius[None, :] - 1e-7 * size)
        # rows of another cell lie beyond the plane half-way between its pivot and the query's own one
        apart = self.apart[home]
        beyond = (d * d - (d[np.arange(len(home)), home] ** 2)[:, None]) / (2 * np.maximum(apart, 1e-300))
        low = np.where(apart > 1e-3 * size, np.maximum(low, beyond - 1e-6 * size), low)
        may = (low * low <= np.maximum(farthest, 0)[:, None] + slack) | np.isnan(farthest)[:, None]
        may &= self.rows[None, :] > 0
        may[np.arange(len(home)), home] = False
        return [np.flatnonzero(r) for r in may]


def _pivoted(corpus: DataFrame, queries: DataFrame, k: int, metric: str, schema: str, cells: int | None = None) -> DataFrame:
    """Many queries: every row belongs to the cell of its nearest pivot, a query first meets the cell it lies in, and then
    those cells only that the triangle inequality does not rule out for its k-th score.

    A corpus row goes to one tile per QUERIES_A_TILE queries of its cell, twice at most for fewer queries, whatever their
    number. Vectors without a score (null, or of no length) meet nothing; they fill up places that no other row takes.
    """
    norm = F.sqrt(F.aggregate(F.col("vec"), F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    sound = F.coalesce(norm < float("inf"), F.lit(False)) & (F.lit(True) if metric == "l2" else norm > 0)
    known = corpus.filter(sound)
    n = known.count()
    undefined = lambda df: [r["id"] for r in df.select("id").orderBy("id").limit(k).collect()]
    fill = lambda qs, ids: qs.select("query_id", F.explode(F.array(*[F.lit(i) for i in ids])).alias("id"), F.lit(float("nan")).alias("score"))
    rest = queries.filter(~F.coalesce(sound, F.lit(False)))
    kinds = {f.name: f.dataType for f in corpus.schema.fields}
    typed = lambda df: df.select("query_id", F.col("id").cast(kinds["id"]).alias("id"), "score")
    parts = []
    if first := undefined(corpus):
        parts.append(typed(fill(rest, first)))
    if n < k and (more := undefined(corpus.filter(~F.coalesce(sound, F.lit(False))))):
        parts.append(typed(fill(queries.filter(sound), more)))
    if n:
        cells = cells or max(1, min(MOST_CELLS, n // ROWS_A_CELL))
        points = [r["vec"] for r in known.orderBy(F.xxhash64("id"), "id").limit(cells).select("vec").collect()]
        pivots = _Pivots(points, metric)
        dim = pivots.at.shape[1]

        @F.pandas_udf("cell int, away double")
        def nearest_pivot(vec: pd.Series) -> pd.DataFrame:
            d = pivots.distances(pivots.placed(_stack(vec.to_list(), dim)))
            cell = d.argmin(axis=1)
            return pd.DataFrame({"cell": cell.astype(np.int32), "away": d[np.arange(len(d)), cell]})

        placed = stable(known.select("id", "vec", nearest_pivot("vec").alias("p")).select("id", "vec", "p.cell", "p.away"))
        for r in placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("away").alias("r")).collect():
            pivots.rows[r["cell"]], pivots.radius[r["cell"]] = r["n"], r["r"]
        asked = stable(queries.filter(sound).select("query_id", "vec", nearest_pivot("vec").alias("p")).select("query_id", "vec", F.col("p.cell").alias("cell")))
        # a query whose own cell holds no row meets the others only
        home = stable(_tiles(placed.drop("away"), asked, k, metric, schema, "cell", QUERIES_A_TILE))
        own = home.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).alias("best"))

        @F.pandas_udf("array<int>")
        def others(vec: pd.Series, best: pd.Series, cell: pd.Series) -> pd.Series:
            return pd.Series(pivots.visited(vec.to_list(), best.to_numpy(np.float64), cell.to_numpy()))

        bound = asked.join(own.withColumnRenamed("query_id", "__q"), F.col("query_id").eqNullSafe(F.col("__q")), "left")
        visits = stable(bound.select("query_id", "vec", F.explode(others("vec", "best", "cell")).alias("cell")))
        parts += [home, _tiles(placed.drop("away"), visits, k, metric, schema, "cell", QUERIES_A_TILE)]
    out = queries.sparkSession.createDataFrame([], schema)
    for part in parts:
        out = out.unionByName(part)
    return out


def nearest(
    corpus: DataFrame, queries: DataFrame, k: int = 3, metric: str = "cosine", max_carried: int = MAX_CARRIED
) -> DataFrame:
    """Top ``k`` corpus rows per query. ``corpus``: id, vec; ``queries``: query_id, vec."""
    corpus, queries = corpus.select("id", "vec"), queries.select("query_id", "vec")
    schema = f"query_id {queries.schema['query_id'].dataType.simpleString()}, id {corpus.schema['id'].dataType.simpleString()}, score double"
    rows = queries.limit(max_carried + 1).collect()
    local = _carried(corpus, rows, k, metric, schema) if len(rows) <= max_carried else _pivoted(corpus, queries, k, metric, schema)
    return _merge(local, k, metric)


def nearest_in_group(corpus: DataFrame, queries: DataFrame, group: str, k: int = 3, metric: str = "cosine") -> DataFrame:
    """Top ``k`` rows per query among the corpus rows of its group. ``corpus``: id, vec, group; ``queries``: query_id, vec, group."""
    schema = f"query_id {queries.schema['query_id'].dataType.simpleString()}, id {corpus.schema['id'].dataType.simpleString()}, score double"
    return _merge(_tiles(corpus.select("id", "vec", group), queries.select("query_id", "vec", group), k, metric, schema, group), k, metric)


def vector_query(
    corpus: DataFrame, queries: DataFrame, k: int = 3, where: Mapping | None = None,
    where_document: Mapping | None = None, metric: str = "cosine", text: str = "text",
) -> DataFrame:
    """Nearest rows among those passing the metadata and content filters, which reach the scan."""
    kept = corpus.filter(compile_where(where, corpus.schema) & compile_where_document(where_document, text))
    return nearest(kept, queries, k, metric)


def route(rows: DataFrame, routes: DataFrame, none_message: str = "no route", max_carried: int = MAX_CARRIED) -> DataFrame:
    """Most similar route per row (first id wins ties), scored inside the row's own task: no shuffle.

    ``rows``: vec and others, a null vec has no score; ``routes``: route, vec, at most ``max_carried`` of them.
    """
    known = routes.orderBy("route").limit(max_carried + 1).collect()
    if len(known) > max_carried:
        # rows need no id of their own, and several may share one: they are numbered, and the numbers written down
        keyed = stable(rows.withColumn("__row", F.monotonically_increasing_id()))
        best = nearest(routes.select(F.col("route").alias("id"), "vec"), keyed.select(F.col("__row").alias("query_id"), "vec"), 1)
        best = best.select(F.col("query_id").alias("__row"), F.col("id").alias("__route"), F.col("score").alias("__score"))
        return keyed.join(best, "__row", "left").select(*rows.columns, F.col("__route").alias("route"), F.col("__score").alias("score"))
    if not known:
        return rows.withColumn("route", F.lit(none_message)).withColumn("score", F.lit(None).cast("double"))
    names = np.array([r["route"] for r in known], dtype=object)
    matrix = _stack([r["vec"] for r in known])
    kind = routes.schema["route"].dataType.simpleString()

    @F.pandas_udf(f"route {kind}, score double")
    def pick(vec: pd.Series) -> pd.DataFrame:
        s = _scores(_stack(vec.to_list(), matrix.shape[1]), matrix, "cosine")
        s = np.where(np.isnan(s), -np.inf, s)
        at = s.argmax(axis=1)
        top = s[np.arange(len(s)), at]
        return pd.DataFrame({"route": names[at], "score": np.where(np.isinf(top), np.nan, top)})

    return rows.withColumn("__r", pick("vec")).select(*rows.columns, "__r.route", F.nanvl("__r.score", F.lit(None)).alias("score"))


def planes(dim: int, tables: int, bits: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((tables, bits, dim))


def _signatures(vec_col: str, tables: int, bits: int, dim: int, seed: int):
    normals = planes(dim, tables, bits, seed).reshape(tables * bits, dim)
    weights = 1 << np.arange(bits)

    @F.pandas_udf("array<long>")
    def sign(vec: pd.Series) -> pd.Series:
        side = (_stack(vec.to_list(), dim) @ normals.T > 0).reshape(len(vec), tables, bits)
        return pd.Series(list((side * weights).sum(axis=2) + (np.arange(tables) << 32)))

    return sign(vec_col)


def nearest_approximate(
    corpus: DataFrame, queries: DataFrame, dim: int, bits: int, k: int = 3, tables: int = 16, seed: int = 7
) -> DataFrame:
    """Approximate top ``k`` by cosine: random-hyperplane buckets give candidates, exact scores rank them.

    ``bits`` is the caller's choice: a bucket of evenly spread rows holds ``corpus rows / 2 ** bits``. Rows meet their bucket
    only; a bucket too big for one task is cut into blocks, so no candidate is dropped. Queries whose buckets hold fewer than
    ``k`` rows are answered exactly.
    """
    c = corpus.select("id", "vec", F.explode(_signatures("vec", tables, bits, dim, seed)).alias("bucket"))
    q = queries.select("query_id", "vec", F.explode(_signatures("vec", tables, bits, dim, seed)).alias("bucket"))
    schema = f"query_id {queries.schema['query_id'].dataType.simpleString()}, id {corpus.schema['id'].dataType.simpleString()}, score double"
    local = _tiles(c, q, k, "cosine", schema, "bucket")
    found = stable(_merge(local.groupBy("query_id", "id").agg(F.max("score").alias("score")), k, "cosine"))
    full = found.groupBy("query_id").agg(F.count("*").alias("__n")).filter(F.col("__n") >= k).select("query_id")
    short = stable(queries.select("query_id", "vec").join(full, "query_id", "left_anti"))
    return found.join(full, "query_id", "left_semi").unionByName(nearest(corpus, short, k))


def _folder(bucket, folder_bits: int):
    """Folder of a bucket: its table, and the last bits of its signature."""
    return (F.shiftright(bucket, 32) * (1 << folder_bits) + bucket.bitwiseAND((1 << folder_bits) - 1)).cast("int")


def _probes(vec_col: str, tables: int, bits: int, dim: int, seed: int, probes: int):
    """Buckets to look into: per table the vector's own one, and those across the ``probes`` planes it is nearest to."""
    normals = planes(dim, tables, bits, seed).reshape(tables * bits, dim)
    weights = 1 << np.arange(bits)
    near = min(probes, bits)

    @F.pandas_udf("array<long>")
    def sign(vec: pd.Series) -> pd.Series:
        margin = (_stack(vec.to_list(), dim) @ normals.T).reshape(len(vec), tables, bits)
        own = ((margin > 0) * weights).sum(axis=2) + (np.arange(tables) << 32)
        across = np.argsort(np.abs(margin), axis=2, kind="stable")[:, :, :near]
        all_of = np.concatenate([own[:, :, None], own[:, :, None] ^ weights[across]], axis=2)
        return pd.Series(list(all_of.reshape(len(vec), tables * (1 + near))))

    return sign(vec_col)


def write_index(corpus: DataFrame, path: str, dim: int, bits: int, tables: int = 16, seed: int = 7, folder_bits: int = 3) -> None:
    """A saved bucket index of ``corpus`` (``id, vec``): signed once, one folder per table and last bits of the signature.

    ``bits`` is the caller's choice, as in ``nearest_approximate``; so is ``folder_bits``, which decides how little a search
    reads. Folders are balanced as they are written: one with a large share of the rows becomes several files.
    """
    spark = corpus.sparkSession
    schema = "dim int, bits int, tables int, seed long, folder_bits int"
    spark.createDataFrame([(dim, bits, tables, seed, folder_bits)], schema).coalesce(1).write.parquet(f"{path}/settings")
    append_index(corpus, path)


def append_index(corpus: DataFrame, path: str) -> None:
    """Adds rows to a saved index. Rows that are added twice, as by a repeated job, are found once."""
    at = corpus.sparkSession.read.parquet(f"{path}/settings").first()
    signed = corpus.select("id", "vec", F.explode(_signatures("vec", at["tables"], at["bits"], at["dim"], at["seed"])).alias("bucket"))
    rows = signed.withColumn("folder", _folder(F.col("bucket"), at["folder_bits"]))
    rows.hint("rebalance", F.col("folder")).write.mode("append").partitionBy("folder").parquet(f"{path}/rows")


def index_rows(spark, path: str, folders: list[int] | None = None) -> DataFrame:
    """Rows ``id, vec, bucket, folder`` of a saved index; only the given folders are read."""
    rows = spark.read.parquet(f"{path}/rows")
    return rows if folders is None else rows.filter(F.col("folder").isin(folders))


def search_index(queries: DataFrame, path: str, k: int = 3, probes: int = 1) -> DataFrame:
    """Approximate top ``k`` by cosine of ``queries`` (``query_id, vec``) from a saved index.

    The corpus is not signed again, and only folders with a probed bucket are read; their list is bounded by the layout.
    Each query looks into its own bucket and, per table, ``probes`` neighbouring ones. A query whose buckets hold fewer than
    ``k`` rows is answered exactly from the first table, which holds every row once.
    """
    spark = queries.sparkSession
    at = spark.read.parquet(f"{path}/settings").first()
    buckets = _probes("vec", at["tables"], at["bits"], at["dim"], at["seed"], probes)
    q = stable(queries.select("query_id", "vec", F.explode(buckets).alias("bucket")))
    folders = [r[0] for r in q.select(_folder(F.col("bucket"), at["folder_bits"])).distinct().collect()]
    rows = index_rows(spark, path, folders).select("id", "vec", "bucket")
    schema = f"query_id {queries.schema['query_id'].dataType.simpleString()}, id {rows.schema['id'].dataType.simpleString()}, score double"
    local = _tiles(rows, q, k, "cosine", schema, "bucket")
    found = stable(_merge(local.groupBy("query_id", "id").agg(F.max("score").alias("score")), k, "cosine"))
    full = found.groupBy("query_id").agg(F.count("*").alias("__n")).filter(F.col("__n") >= k).select("query_id")
    short = stable(queries.select("query_id", "vec").join(full, "query_id", "left_anti"))
    if short.isEmpty():
        return found
    once = index_rows(spark, path).filter(F.col("folder") < 1 << at["folder_bits"]).select("id", "vec").dropDuplicates(["id"])
    return found.join(full, "query_id", "left_semi").unionByName(nearest(once, short, k))
