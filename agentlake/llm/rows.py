"""Helpers the operators of this folder share: table access, row keys, batch sizes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agentlake.core import table

__all__ = ["table", "texts", "small_batches", "held"]

#: Rows of one Arrow batch: texts are long, and a worker holds a batch with what it makes of it.
BATCH_ROWS = 400


_HELD: dict[str, object] = {}


def held(name: str, make: Callable[[], object]):
    """What a Python worker keeps from task to task: one model with what it remembers, the last one asked for."""
    if name not in _HELD:
        _HELD.clear()
        _HELD[name] = make()
    return _HELD[name]


def small_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch so that one batch of whole texts stays in the tens of megabytes."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def texts(docs: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """``keep`` and the text column as ``text``, null texts as empty ones."""
    small_batches(docs.sparkSession)
    return docs.select(*keep, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
