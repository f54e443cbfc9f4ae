"""TF-IDF retrieval: fit on one table, score another, cosine above a threshold.

Lower-cased words of two or more letters, digits or underscores, without stop words; idf = ln((1 + n) / (1 + df)) + 1;
unit-length vectors; words the fitted table does not have are dropped.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from agentlake.core import fits, spread, stable
from agentlake.operators.scans import numbered_in_file_order

WORD = r"[\p{L}\p{N}_]{2,}"
# stop words, our own short list
STOP_WORDS = (
    "about above after again all also am an and any are as at be because been before being below between both but by "
    "can could did do does doing down during each few for from further had has have having he her here hers him his how "
    "if in into is it its just me more most my no nor not of off on once only or other our out over own same she should "
    "so some such than that the their them then there these they this those through to too under until up very was we "
    "were what when where which while who whom why will with would you your"
).split()
MAX_POSTINGS, MAX_POSTING_BYTES = 400_000, 32 << 20
DIGITS = 6
CELLS = 1 << 18  # document x query sums, and products of a word's weights, held at once in a task
BROADCAST_WORDS = 200_000  # a smaller (term, idf) table, and no more postings of queries, travel to the other side of a join
CARRIED_WORDS, CARRIED_CHARS = 1 << 19, 64  # the most frequent words, up to a length, that tasks hold
WORDS_AT_ONCE = 1 << 19  # words of documents that a task counts at once (one document, if that alone has more)


def parted(docs: DataFrame, id_col: str) -> tuple[DataFrame, DataFrame | None]:
    """The rows with an id of their own, and those whose ids have several rows (None: there are none)."""
    several = stable(docs.groupBy(F.col(id_col).alias("__id")).agg(F.count("*").alias("n")).filter("n > 1").select("__id"))
    if several.isEmpty():
        return docs, None
    several = several.hint("broadcast" if fits(several, BROADCAST_WORDS) else "merge")
    same = F.col(id_col).eqNullSafe(F.col("__id"))
    return docs.join(several, same, "left_anti"), docs.join(several, same, "left_semi")


def word_lists(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id, words): the words of each row, stop words and repeats included."""
    found = F.regexp_extract_all(F.lower(F.col(text)), F.lit(f"({WORD})"), F.lit(1))
    return spread(docs.select(id_col, text)).select(F.col(id_col).alias("id"), found.alias("words"))


def term_counts(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id, term, tf); counts are combined in the task that holds the document before they move."""
    return (
        word_lists(docs, id_col, text).select("id", F.explode("words").alias("term"))
        .filter(~F.col("term").isin(STOP_WORDS))
        .groupBy("id", "term")
        .agg(F.count("*").alias("tf"))
    )


def fit(docs: DataFrame, id_col: str, text: str, parts: tuple[DataFrame, DataFrame | None] | None = None) -> DataFrame:
    """(term, idf) of a corpus; the document count includes documents without words. ``parts``: its ``parted`` rows, if known.

    Words of a row with an id of its own are made distinct in the row; only those of ids with several rows move with their ids.
    """
    n = docs.agg(F.count("*").alias("n")).scalar()
    lone, several = parted(docs, id_col) if parts is None else parts
    terms = word_lists(lone, id_col, text).select(F.explode(F.array_distinct("words")).alias("term")).filter(~F.col("term").isin(STOP_WORDS))
    if several is not None:
        terms = terms.unionByName(term_counts(several, id_col, text).select("term"))
    df = terms.groupBy("term").agg(F.count("*").alias("df"))
    return df.select("term", (F.log((1 + n) / (1 + F.col("df"))) + 1).alias("idf"))


def transform(
    docs: DataFrame, id_col: str, text: str, idf: DataFrame, wanted: DataFrame | None = None,
    parts: tuple[DataFrame, DataFrame | None] | None = None,
) -> DataFrame:
    """One row per document: its (term, weight) list of unit length. A document's list is as long as its words.

    With ``wanted`` (term, number) the lists hold the numbers of the wanted terms; the others count for the length only.
    Words are counted and weighed in the task that holds the document, which knows the most frequent words (smallest idf).
    Only the other words, and all of ids with several rows, are joined with ``idf``. ``parts``: the ``parted`` rows, if known.
    """
    known = idf.withColumn("at", F.col("term")) if wanted is None else idf.join(wanted.select("term", F.col("number").alias("at")), "term", "left")
    known = stable(known.filter(F.col("idf").isNotNull()))
    short, held, least = F.length("term") <= CARRIED_CHARS, 0, None
    for r in sorted(known.groupBy("idf").agg(F.count_if(short).alias("n")).collect()):
        held += r["n"]
        if held > CARRIED_WORDS:
            break
        least = r["idf"]
    carried = known.filter(short & (F.col("idf") <= F.lit(least))).toArrow().combine_chunks()
    lone, several = parted(docs, id_col) if parts is None else parts
    more = carried.num_rows < known.count()
    kind, at = docs.schema[id_col].dataType.simpleString(), known.schema["at"].dataType.simpleString()
    main = word_lists(lone, id_col, text).mapInArrow(
        _weigher(carried, more), f"id {kind}, term array<{at}>, w array<double>, square double, rest array<struct<term: string, tf: long>>"
    )
    unit = F.transform("w", lambda x: x / F.sqrt("square")).alias("w")
    if not more and several is None:
        return main.select("id", "term", unit).select("id", F.arrays_zip("term", "w").alias("ws"))
    main = stable(main)
    rest = main.select("id", F.explode("rest").alias("x")).select("id", "x.term", "x.tf")
    if several is not None:
        rest = rest.unionByName(term_counts(several, id_col, text))
    # the planner sizes exploded words like the text they come from and would broadcast them: beyond a checked bound ask for
    # a merge join, whose skew splitting also takes care of words that are in most documents
    weighted = rest.join(known.hint("broadcast" if fits(known, BROADCAST_WORDS) else "merge"), "term")
    weighted = weighted.select(F.col("id").alias("__id"), "at", (F.col("tf") * F.col("idf")).alias("w"))
    per_doc = weighted.groupBy("__id").agg(
        F.collect_list(F.when(F.col("at").isNotNull(), F.struct("at", "w"))).alias("ws"), F.sum(F.col("w") * F.col("w")).alias("__square"),
        F.lit(True).alias("__has"),
    )
    both = main.join(per_doc.hint("merge"), F.col("id").eqNullSafe(F.col("__id")), "full")
    both = both.filter(F.col("__has") | (F.col("square") > 0))
    both = both.select(
        F.when(F.col("square").isNull(), F.col("__id")).otherwise(F.col("id")).alias("id"),
        *[F.concat(*[F.coalesce(x, F.array().cast(f"array<{k}>")) for x in (name, f"ws.{also}")]).alias(name) for name, also, k in (("term", "at", at), ("w", "w", "double"))],
        (F.coalesce("square", F.lit(0.0)) + F.coalesce("__square", F.lit(0.0))).alias("square"),
    )
    return both.select("id", "term", unit).select("id", F.arrays_zip("term", "w").alias("ws"))


def _weigher(carried: pa.Table, more: bool):
    """The batch function of ``transform``: weights of the carried words, not yet of unit length, the sum of their squares, and
    the counts of the other words if there are ``more`` that have an idf."""
    terms, idf, at = (carried.column(c).combine_chunks() for c in ("term", "idf", "at"))
    idf, asked = idf.to_numpy(), at.is_valid().to_numpy(False)

    def weigh(batches):
        for batch in batches:
            size = np.concatenate([[0], np.cumsum(pc.list_value_length(batch.column("words")).fill_null(0).to_numpy())])
            low = 0
            while low < batch.num_rows:
                high = min(batch.num_rows, max(low + 1, int(np.searchsorted(size, size[low] + WORDS_AT_ONCE, side="right")) - 1))
                if size[high] > size[low]:
                    yield counted(batch.slice(low, high - low), np.diff(size[low : high + 1]))
                low = high

    def lists(doc, rows, values):
        return pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(rows + 1)), pa.int32()), values)

    def counted(part, many):
        words = part.column("words").flatten().dictionary_encode()
        unique = words.dictionary
        plain = ~pc.is_in(unique, value_set=pa.array(STOP_WORDS, unique.type)).to_numpy(False)
        place = pc.index_in(unique, value_set=terms.cast(unique.type)).fill_null(-1).to_numpy()
        cell, tf = np.unique(np.repeat(np.arange(len(many)), many) * len(unique) + words.indices.to_numpy(), return_counts=True)
        doc, word = np.divmod(cell, len(unique))
        held, other = (np.flatnonzero(plain[word] & x) for x in (place[word] >= 0, place[word] < 0))
        d, v = doc[held], place[word[held]]
        w = tf[held] * idf[v]
        square, use = np.bincount(d, w * w, minlength=len(many)).astype(np.float64), asked[v]  # of no words it has integers
        other = other if more else other[:0]
        rest = pa.StructArray.from_arrays([unique.take(pa.array(word[other])), pa.array(tf[other], pa.int64())], ["term", "tf"])
        columns = [part.column("id"), lists(d[use], len(many), at.take(pa.array(v[use]))), lists(d[use], len(many), pa.array(w[use])), pa.array(square)]
        out = pa.RecordBatch.from_arrays([*columns, lists(doc[other], len(many), rest)], ["id", "term", "w", "square", "rest"])
        return out.filter(pa.array((square > 0) | (np.bincount(doc[other], minlength=len(many)) > 0)))

    return weigh


def _carried(docs: DataFrame, asked: list, threshold: float, strict: bool, schema: str) -> DataFrame:
    """Score batches of documents against the asked postings inside the task; only hits leave it."""
    postings: dict[str, list] = defaultdict(list)
    names = sorted({r["query_id"] for r in asked})
    at = {q: i for i, q in enumerate(names)}
    for r in asked:
        postings[r["term"]].append((at[r["query_id"]], r["w"]))
    vocab = list(postings)
    start = np.cumsum([0] + [len(v) for v in postings.values()])
    q_of = np.array([q for v in postings.values() for q, _ in v], dtype=np.int64)
    w_of = np.array([w for v in postings.values() for _, w in v], dtype=np.float64)
    width = max(1, len(names))
    step = max(1, CELLS // width)

    def score(batches):
        for batch in batches:
            lists = batch.column("ws")
            known = pa.array(vocab, lists.type.value_type.field("term").type)
            size = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).fill_null(0).to_numpy())])
            flat = lists.flatten()
            term = pc.index_in(flat.field("term"), value_set=known).fill_null(-1).to_numpy()
            weights = flat.field("w").to_numpy()
            # products of all documents up to each one
            work = np.concatenate([[0], np.cumsum(np.where(term >= 0, start[term + 1] - start[term], 0))])[size]
            low = 0
            while low < batch.num_rows:
                high = min(low + step, int(np.searchsorted(work, work[low] + CELLS, side="right")) - 1)
                high = min(max(high, low + 1), batch.num_rows)
                cut = slice(size[low], size[high])
                yield from hits(batch.slice(low, high - low).column("id"), np.diff(size[low : high + 1]), term[cut], weights[cut])
                low = high

    def hits(doc_ids, size, term, weight):
        rows = len(size)
        doc = np.repeat(np.arange(rows), size)
        used = np.flatnonzero(term >= 0)
        if not len(used):
            return
        term, weight = term[used], weight[used]
        many = start[term + 1] - start[term]
        pos = np.repeat(start[term] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        cell = np.repeat(doc[used], many) * width + q_of[pos]
        s = np.round(np.bincount(cell, np.repeat(weight, many) * w_of[pos], minlength=rows * width), DIGITS)
        hit = np.flatnonzero((s > threshold) if strict else (s >= threshold) & (s > 0))
        asked_ids = pa.array(names).take(pa.array(hit % width))
        yield pa.RecordBatch.from_arrays([asked_ids, doc_ids.take(pa.array(hit // width)), pa.array(s[hit])], ["query_id", "id", "score"])

    return docs.mapInArrow(score, schema)


def candidates(docs: DataFrame, asked: DataFrame, threshold: float) -> DataFrame:
    """(query_id, id): the pairs that may reach the threshold, by a prefix filter. ``asked``: query_id, term, w.

    A query's words are ordered by how many documents have them. Its most frequent words, as long as together they cannot
    reach the threshold in any document (their weights times the largest weights there are, or their length, as vectors of
    documents have length one), make no pair by themselves: only the rarer ones are looked up. What these add up to, and
    what the others can add at most, must reach the threshold too. Rarer ones up to a bound travel to the documents.
    """
    least = threshold - 2 * 10.0**-DIGITS
    flat = docs.select("id", F.explode("ws").alias("x")).select("id", F.col("x.term").alias("term"), F.col("x.w").alias("dw"))
    tops = flat.groupBy("term").agg(F.count("*").alias("n"), F.max("dw").alias("top"))
    common = Window.partitionBy("query_id").orderBy(F.desc("n"), "term").rowsBetween(Window.unboundedPreceding, 0)
    reach = F.least(F.sum(F.col("w") * F.col("top")).over(common), F.sqrt(F.sum(F.col("w") * F.col("w")).over(common)))
    placed = asked.join(tops, "term").withColumn("reach", reach)
    left_out = F.max(F.when(F.col("reach") < least, F.col("reach"))).over(Window.partitionBy("query_id"))
    rare = placed.withColumn("more", F.coalesce(left_out, F.lit(0.0))).filter(F.col("reach") >= least).select("query_id", "term", "w", "more")
    rare = stable(rare)
    rare = rare.hint("broadcast" if fits(rare, BROADCAST_WORDS) else "merge")
    sums = flat.join(rare, "term").groupBy("query_id", "id").agg(F.sum(F.col("dw") * F.col("w")).alias("s"), F.first("more").alias("more"))
    return sums.filter(F.col("s") + F.col("more") >= least).select("query_id", "id")


def match(docs: DataFrame, queries: DataFrame, threshold: float, strict: bool = False, max_postings: int = MAX_POSTINGS) -> DataFrame:
    """(query_id, id, score) at or above the threshold (above it when ``strict``). Both sides come from ``transform``.

    Query postings within the bounds, in rows and in bytes, are carried to the documents and only hits are emitted; beyond
    them the pairs that may reach the threshold are found first, and the scores of those alone are added up.
    """
    return _matched(docs, postings(queries), threshold, strict, max_postings)


def postings(queries: DataFrame) -> DataFrame:
    return queries.select(F.col("id").alias("query_id"), F.explode("ws").alias("x")).select("query_id", "x.term", "x.w")


def _matched(docs: DataFrame, asked: DataFrame, threshold: float, strict: bool, max_postings: int) -> DataFrame:
    """``match`` of documents with the postings (query_id, term, w)."""
    kinds = [asked.schema["query_id"].dataType.simpleString(), docs.schema["id"].dataType.simpleString()]
    n, size = asked.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(F.col("term").cast("string")) + 16), F.lit(0))).first()
    if n <= max_postings and size <= MAX_POSTING_BYTES:
        return _carried(docs, asked.collect(), threshold, strict, f"query_id {kinds[0]}, id {kinds[1]}, score double")
    # two arrays are kept in place of one of structs: 12 bytes a number and its weight
    docs, asked = stable(docs.select("id", F.col("ws.term").alias("term"), F.col("ws.w").alias("w"))), stable(asked)
    found = candidates(docs.select("id", F.arrays_zip("term", "w").alias("ws")), asked, threshold)
    found = stable(found.select(F.col("query_id").alias("__q"), F.col("id").alias("__d")))
    found = found.hint("broadcast" if fits(found, BROADCAST_WORDS) else "merge")
    words = asked.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("term", "w"))).alias("words"))
    words = words.select("query_id", F.col("words.term").alias("asked"), F.col("words.w").alias("asked_w"))
    words = words.hint("broadcast" if n <= MAX_POSTINGS and size <= MAX_POSTING_BYTES else "merge")
    both = docs.join(found, F.col("__d").eqNullSafe(F.col("id"))).join(words, F.col("__q").eqNullSafe(F.col("query_id")))
    both = both.select("query_id", "id", "term", "w", "asked", "asked_w")
    return both.mapInArrow(_scorer(threshold, strict), f"query_id {kinds[0]}, id {kinds[1]}, score double")


def _scorer(threshold: float, strict: bool):
    """The batch function that adds up the score of each pair of a document's and a query's words, and hands on the hits."""
    def score(batches):
        for batch in batches:
            many = [pc.list_value_length(batch.column(c)).to_numpy() for c in ("term", "asked")]
            work = np.concatenate([[0], np.cumsum(many[0] + many[1])])
            low = 0
            while low < batch.num_rows:
                high = min(batch.num_rows, max(low + 1, int(np.searchsorted(work, work[low] + CELLS, side="right")) - 1))
                yield from hits(batch.slice(low, high - low), [np.repeat(np.arange(high - low), x[low:high]) for x in many])
                low = high

    def hits(part, pair):
        terms = [part.column(c).flatten() for c in ("term", "asked")]
        if pa.types.is_integer(terms[0].type):
            terms = [x.to_numpy() for x in terms]
        else:
            terms = np.split(pa.concat_arrays(terms).dictionary_encode().indices.to_numpy(), [len(terms[0])])
        span = int(max(x.max(initial=0) for x in terms)) + 1
        mine, asked = (at * span + x for at, x in zip(pair, terms))
        order = np.argsort(asked, kind="stable")
        asked = np.append(asked[order], -1)
        place = np.searchsorted(asked[:-1], mine)
        both = np.flatnonzero(asked[place] == mine)
        w, asked_w = (part.column(c).flatten().to_numpy() for c in ("w", "asked_w"))
        sums = np.bincount(pair[0][both], w[both] * asked_w[order][place[both]], minlength=part.num_rows)
        s = np.round(sums.astype(np.float64), DIGITS)
        hit = pa.array(np.flatnonzero((s > threshold) if strict else (s >= threshold) & (s > 0)))
        if len(hit):
            yield pa.RecordBatch.from_arrays([*[part.column(c).take(hit) for c in ("query_id", "id")], pa.array(s).take(hit)], ["query_id", "id", "score"])

    return score


def search(
    docs: DataFrame, queries: DataFrame, threshold: float = 0.15, fit_on: str = "docs", strict: bool = False,
    id_col: str = "id", text: str = "text", query_id: str = "query_id", query_text: str = "text", max_postings: int = MAX_POSTINGS,
) -> DataFrame:
    """Fit on the documents (or on the queries), then match every query with every document above the threshold.

    The texts are read and cut into words twice, to fit and to weigh, rather than written as words; of their words only the
    numbers of those asked for are gathered. The (term, idf) table and the asked postings are written once.
    """
    parts = parted(docs, id_col)
    idf = stable(fit(docs, id_col, text, parts) if fit_on == "docs" else fit(queries, query_id, query_text))
    asked = stable(postings(transform(queries, query_id, query_text, idf)))
    wanted = numbered_in_file_order(asked.select("term").distinct(), "number").withColumn("number", F.col("number").cast("int"))
    wanted = stable(wanted)
    asked = asked.join(wanted, "term").select("query_id", F.col("number").alias("term"), "w")
    return _matched(transform(docs, id_col, text, idf, wanted, parts), stable(asked), threshold, strict, max_postings)


def boosted(
    hits: DataFrame, docs: DataFrame, queries: DataFrame, id_col: str = "id",
) -> DataFrame:
    """Add the rule boosts to text scores: same code .2, amount within 50 / 100 .1 / .05, same patient .1, at most 1.

    ``docs``: id, code, amount, patient; ``queries``: query_id, code, amount, patient.
    """
    d = docs.select(F.col(id_col).alias("id"), F.col("code").alias("dc"), F.col("amount").alias("da"), F.col("patient").alias("dp"))
    q = queries.select("query_id", F.col("code").alias("qc"), F.col("amount").alias("qa"), F.col("patient").alias("qp"))
    diff = F.abs(F.col("da") - F.col("qa"))
    near = F.when(F.col("qa") > 0, F.when(diff < 50, 0.1).when(diff < 100, 0.05).otherwise(0.0)).otherwise(0.0)
    boost = F.when(F.col("dc") == F.col("qc"), 0.2).otherwise(0.0) + near + F.when(F.col("dp") == F.col("qp"), 0.1).otherwise(0.0)
    final = F.round(F.least(F.lit(1.0), F.col("score") + boost), DIGITS)
    return hits.join(d, "id").join(q, "query_id").select("query_id", "id", final.alias("score"))
