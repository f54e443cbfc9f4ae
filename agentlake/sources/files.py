"""File sources and sinks: request CSV, JSON documents, multi-page files, chunks and embeddings, ledger, results."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agentlake.core import shared_dir
from agentlake.functions.text import template
from agentlake.operators.ledger import split_valid
from agentlake.operators.scans import numbered_in_file_order

REQUEST_SCHEMA = "job string, need_size string, event string, request string, request_date string"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder in the shared folder, one per run."""
    return f"{shared_dir(spark).rstrip('/')}/agentlake-{name}-{uuid.uuid4().hex}"


def read_requests(spark: SparkSession, path: str, schema: str | T.StructType = REQUEST_SCHEMA, row_id: str | None = None) -> DataFrame:
    """CSV with a header and quoted text over several lines; optional dense row ids in file order."""
    df = (
        spark.read.schema(schema).option("header", True).option("multiLine", True)
        .option("quote", '"').option("escape", '"').csv(path)
    )
    return df if row_id is None else numbered_in_file_order(df, row_id)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).option("quoteAll", True).option("escape", '"').csv(path)


def export_results(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header; list, map and struct columns as JSON text."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    flat = [F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name) for f in df.schema.fields]
    write_csv(df.select(*flat), path, mode)


def read_json_documents(
    spark: SparkSession, path: str, schema: str | T.StructType, pattern: str, id_pattern: str = r"([^/]+)\.json$"
) -> DataFrame:
    """Folder of JSON files, one object each, to (id, content, metadata): id from the file path, content from a template."""
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    df = spark.read.schema(fields).option("multiLine", True).option("recursiveFileLookup", True).json(path)
    names = [f.name for f in fields.fields]
    meta = F.create_map(*[x for n in names for x in (F.lit(n), F.col(n).cast("string"))])
    return df.select(
        F.regexp_extract(F.col("_metadata.file_path"), id_pattern, 1).alias("id"),
        template(pattern, {n: F.col(n) for n in names}).alias("content"), meta.alias("metadata"),
    )


def extract_pages(df: DataFrame, key: str, content: str, extractor: Callable[[object], Iterable[str]]) -> DataFrame:
    """One row per non-empty page: (key, page, text); pages count from 1. A file is read whole by one call."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        for pdf in batches:
            rows = [(k, n, t) for k, body in zip(pdf[key], pdf[content]) for n, t in enumerate(extractor(body), 1) if t and t.strip()]
            yield pd.DataFrame(rows, columns=[key, "page", "text"])

    return df.select(key, content).mapInPandas(run, f"{key} {kind}, page long, text string")


def split_pages(df: DataFrame, key: str, content: str, pattern: str, drop: str = "") -> DataFrame:
    """One row per non-empty page, as ``extract_pages``, where a pattern tells the pages: its first group is a page's text.

    What matches ``drop`` is taken out of a page. Column functions only.
    """
    found = df.select(key, F.posexplode(F.regexp_extract_all(F.col(content), F.lit(pattern), F.lit(1))).alias("__at", "__page"))
    text = F.regexp_replace("__page", drop, "") if drop else F.col("__page")
    out = found.select(key, (F.col("__at") + 1).cast("long").alias("page"), text.alias("text"))
    return out.filter(F.regexp_replace("text", r"\s+", "") != "")


def read_page_documents(spark: SparkSession, path: str, extractor: Callable[[bytes], Iterable[str]]) -> DataFrame:
    """Multi-page files to one document per non-empty page, keyed by (path, page)."""
    return extract_pages(spark.read.format("binaryFile").load(path), "path", "content", extractor)


def write_chunks(chunks: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Chunks as Parquet, or as CSV with the columns text and chunk_size."""
    if fmt == "csv":
        write_csv(chunks.select("text", "chunk_size"), path, mode)
    else:
        chunks.write.mode(mode).format(fmt).save(path)


def read_chunks(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return read_requests(spark, path, "text string, chunk_size int") if fmt == "csv" else spark.read.format(fmt).load(path)


def write_embeddings(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines, one ``{..., "embedding": [...]}`` object per row."""
    df.write.mode(mode).json(path)


def read_embeddings(spark: SparkSession, path: str, schema: str = "text string, embedding array<float>") -> DataFrame:
    return spark.read.schema(schema).json(path)


def append_transactions(df: DataFrame, path: str, mode: str = "append") -> DataFrame:
    """Write the accepted rows to the ledger folder; the rejected rows come back with their reason."""
    good, bad = split_valid(df)
    good.write.mode(mode).parquet(path)
    return bad


def dimension(spark: SparkSession, schema: str | T.StructType, rows: Sequence[tuple]) -> DataFrame:
    """Small constant table with an explicit schema."""
    return spark.createDataFrame(list(rows), schema)
