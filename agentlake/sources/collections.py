"""Document collections as Parquet folders under one root: create, get, list, drop, append, count, peek."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agentlake.operators.scans import one_per_key


class Collections:
    """Lifecycle of named collections. Each is a folder ``root/name``; appends keep ids unique."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, name: str) -> str:
        if not name or "/" in name:
            raise ValueError("a collection name is one path segment")
        return f"{self.root}/{name}"

    def _hadoop(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def exists(self, name: str) -> bool:
        fs, p = self._hadoop(self._path(name))
        return fs.exists(p)

    def names(self) -> list[str]:
        fs, p = self._hadoop(self.root)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def create(self, name: str, schema, force: bool = False) -> DataFrame:
        if self.exists(name) and not force:
            raise ValueError(f"collection {name} exists")
        self.spark.createDataFrame([], schema).write.mode("overwrite").parquet(self._path(name))
        return self.get(name)

    def get(self, name: str) -> DataFrame:
        if not self.exists(name):
            raise KeyError(name)
        return self.spark.read.parquet(self._path(name))

    def get_or_create(self, name: str, schema) -> DataFrame:
        return self.get(name) if self.exists(name) else self.create(name, schema)

    def delete(self, name: str) -> bool:
        fs, p = self._hadoop(self._path(name))
        return fs.delete(p, True)

    def add(self, name: str, docs: DataFrame, id_col: str = "id") -> DataFrame:
        """Append the documents whose id is new; of several new rows with one id, one is kept."""
        have = self.get(name)
        fresh = new_rows(have, docs, id_col)
        fresh.select(*have.columns).write.mode("append").parquet(self._path(name))
        return self.get(name)


def new_rows(existing: DataFrame, docs: DataFrame, id_col: str) -> DataFrame:
    """Documents with ids that are not there; of several with one id, ``scans.one_per_key`` takes one."""
    return one_per_key(docs, [id_col]).join(existing.select(id_col), id_col, "left_anti")


def add_documents(existing: DataFrame, docs: DataFrame, id_col: str = "id") -> DataFrame:
    """``existing`` and the documents with ids it does not have."""
    return existing.unionByName(new_rows(existing, docs, id_col))


def peek(df: DataFrame, n: int, id_col: str) -> DataFrame:
    return df.orderBy(id_col).limit(n)


def with_count(sample: DataFrame, whole: DataFrame, name: str = "n") -> DataFrame:
    """Sample rows next to the row count of the whole collection, a scalar subquery."""
    return sample.withColumn(name, whole.agg(F.count("*").alias(name)).scalar())
