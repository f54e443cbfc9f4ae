"""A training corpus from ``documents``: language, near-duplicates, secrets, mixture, tokens.

Every stage takes ``(spark, docs, sf_dir)``; ``run`` writes each result as Parquet into the shared folder and reads it again for
the next stage. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agentlake.core import shared_dir, table
from agentlake.llm import bpe, langid, mixing, secrets, simhash


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, and those no learned language is likely for, go; ``lang`` becomes the predicted one."""
    return langid.kept_languages(docs, public_tokenizers.path("piece_bpe_32k.model"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints, the document with the smallest id stays."""
    return simhash.first_of_each(docs)


def secret_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets, and weak candidates that are linked to complementary parts, are replaced by their kind."""
    return secrets.redact(docs).withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the balanced mix takes it: not at all, once or twice."""
    return mixing.repeat(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, source, lang``, token ids (little-endian unsigned 32-bit), their number, and digests of ids and decoded text."""
    out = bpe.round_trip(docs, public_tokenizers.path("word_bpe_49k.json"), ("doc_id", "source", "lang"))
    return out.select(
        "doc_id", "source", "lang", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("secret_spans", secret_spans),
    ("mixture", mixture),
    ("tokens", tokens),
]

#: SQL can express neither the language model nor the fingerprints nor the tokens.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/corpus-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
