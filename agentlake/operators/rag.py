"""Retrieval-augmented generation over tables: contexts, prompts, several collections, the context waterfall."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agentlake.functions.text import template, truncate
from agentlake.core import stable
from agentlake.operators.neighbours import nearest, nearest_in_group, route

PROMPT = "Answer from the context.\n\nContext:\n{context}\n\nQuestion: {question}\n\nAnswer:"


def contexts(hits: DataFrame, docs: DataFrame, id_col: str, text: str, max_chars: int | None = None) -> DataFrame:
    """Texts of the hits of each query, best first, joined by blank lines. At most k texts per query are gathered.

    ``hits``: query_id, rank, id. ``max_chars`` shortens the joined text and marks it with ``...``.
    """
    texts = hits.join(docs.select(F.col(id_col).alias("id"), F.col(text).alias("__text")), "id")
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "__text"))), lambda x: x["__text"]), "\n\n")
    out = texts.groupBy("query_id").agg(F.count("*").alias("n_docs"), body.alias("context"))
    return out if max_chars is None else out.withColumn("context", truncate(F.col("context"), max_chars))


def prompts(context: DataFrame, questions: DataFrame, question: str, pattern: str = PROMPT) -> DataFrame:
    """One prompt per question; a question without hits has an empty context."""
    rows = questions.join(context, "query_id", "left")
    return rows.withColumn("prompt", template(pattern, {"context": F.col("context"), "question": F.col(question)}))


def search_collections(collections: Mapping[str, DataFrame], queries: DataFrame, k: int = 3, metric: str = "cosine") -> DataFrame:
    """Nearest rows of every collection, with the name of the collection as ``source``."""
    out = None
    for name, corpus in collections.items():
        part = nearest(corpus, queries, k, metric).withColumn("source", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


def search_routed(collections: Mapping[str, DataFrame], routes: DataFrame, queries: DataFrame, k: int = 3) -> DataFrame:
    """Each query goes to the collection whose route vector is most similar. ``routes``: route (collection name), vec.

    Queries are routed once; all collections are searched by one join on the route.
    """
    sent = stable(route(queries.select("query_id", "vec"), routes).select("query_id", "vec", F.col("route").alias("source")))
    rows = None
    for name, corpus in collections.items():
        part = corpus.select("id", "vec", F.lit(name).alias("source"))
        rows = part if rows is None else rows.unionByName(part)
    hits = nearest_in_group(rows, sent, "source", k)
    return hits.join(sent.select("query_id", "source"), "query_id").select(*hits.columns, "source")


def choose_context(
    df: DataFrame, useful: str, documents: Column, memory: Column, external: Column
) -> DataFrame:
    """Waterfall: the documents when judged useful, else a memory hit, else the external text; ``store`` marks answers
    from outside, the only ones worth remembering."""
    from_docs = F.coalesce(F.col(useful), F.lit(False))
    has_memory = F.coalesce(F.length(memory) > 0, F.lit(False))
    source = F.when(from_docs, "documents").when(has_memory, "memory").otherwise("external")
    text = F.when(from_docs, documents).when(has_memory, memory).otherwise(external)
    return df.withColumns({"source": source, "context": text}).withColumn("store", F.col("source") == "external")
