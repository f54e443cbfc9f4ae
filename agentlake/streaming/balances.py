"""Running sums of a stream as tables: snapshots and what came since.

A micro-batch adds one small delta (sums per key). Every ``every`` batches the deltas are folded into a new snapshot, so a
reader sees one snapshot and fewer than ``2 * every`` deltas, however many batches there were. All folders are named by batch
number: a batch that is repeated overwrites its own, and the state before a batch never holds that batch.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class Balances:
    """Sums per key in the folder ``path`` of the shared storage.

    ``keys`` name columns, ``sums`` are the summed ones; both are columns of ``schema`` and of every batch. Null keys are keys.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], sums: Sequence[str], every: int = 16):
        self.spark, self.path, self.keys, self.sums, self.every = spark, path, list(keys), list(sums), every
        self.schema = StructType([schema[c] for c in [*keys, *sums]])

    def _summed(self, rows: DataFrame) -> DataFrame:
        total: Mapping[str, Column] = {c: F.sum(c).cast(self.schema[c].dataType).alias(c) for c in self.sums}
        return rows.groupBy(*self.keys).agg(*total.values())

    def _numbers(self, kind: str) -> list[int]:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}")
        fs = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(folder):
            return []
        # a folder without its mark of success is one that was not written to the end
        done = (s.getPath() for s in fs.listStatus(folder))
        return sorted(int(p.getName()) for p in done if fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))

    def _drop(self, kind: str, numbers: Sequence[int]) -> None:
        for n in numbers:
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}/{n}")
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

    def _read(self, kind: str, n: int) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/{kind}/{n}")

    def open_with(self, rows: DataFrame) -> None:
        """What holds before the first batch."""
        self._summed(rows).write.mode("overwrite").parquet(f"{self.path}/snapshot/-1")

    def before(self, batch_id: int) -> DataFrame:
        """Sums of all batches before ``batch_id``."""
        return self._until(batch_id, batch_id)

    def _until(self, batch_id: int, older: int) -> DataFrame:
        """The same, from a snapshot of a batch before ``older``."""
        last = max((n for n in self._numbers("snapshot") if n < older), default=None)
        out = self.spark.createDataFrame([], self.schema) if last is None else self._read("snapshot", last)
        since = [n for n in self._numbers("delta") if (last is None or n > last) and n < batch_id]
        for n in since:
            out = out.unionByName(self._read("delta", n))
        return self._summed(out) if since else out

    def now(self) -> DataFrame:
        return self.before(max(self._numbers("delta"), default=-1) + 1)

    def add(self, batch_id: int, rows: DataFrame) -> None:
        """The rows of a batch, once however often it is repeated; at times a new snapshot."""
        self._summed(rows).write.mode("overwrite").parquet(f"{self.path}/delta/{batch_id}")
        if (batch_id + 1) % self.every:
            return
        self._until(batch_id + 1, batch_id).write.mode("overwrite").parquet(f"{self.path}/snapshot/{batch_id}")
        # the snapshot before this one stays, with the deltas since, for a batch that is repeated
        kept = [n for n in self._numbers("snapshot") if n <= batch_id][-2:]
        self._drop("snapshot", [n for n in self._numbers("snapshot") if n < kept[0]])
        self._drop("delta", [n for n in self._numbers("delta") if n <= kept[0]])
