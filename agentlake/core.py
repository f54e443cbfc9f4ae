"""Session, table access, reliable checkpoints, size checks."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "agentlake", master: str | None = None, partitions: int | None = None) -> SparkSession:
    """A session for local runs; on a cluster the submitted configuration wins."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # at run time, a join whose build partitions all proved small skips both sorts
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64MB")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master).config("spark.driver.memory", os.environ.get("AGENTLAKE_DRIVER_MEMORY", "12g"))
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_SCHEMAS: dict[str, object] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is read from the files once per path."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


_LOCAL_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only where that is unset *and* the master is local (tests) a temporary folder is taken.
    """
    known = _LOCAL_DIRS.get(spark.sparkContext.applicationId)
    if known:
        return known
    conf = spark.sparkContext.getConf()
    path = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    known = spark.sparkContext.getCheckpointDir()
    if known:
        return known.rsplit("/", 1)[0]
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    # the running session does not take the key any more, so the folder is remembered here
    return _LOCAL_DIRS.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="agentlake-ckpt-"))


def stable(df: DataFrame) -> DataFrame:
    """Cut lineage into reliable storage: the rows read later are the rows written now, also after executor loss."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint()


def fits(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows; reads no more than ``max_rows + 1``."""
    return df.limit(max_rows + 1).count() <= max_rows


def spread(df: DataFrame) -> DataFrame:
    """Give heavy per-row text work enough tasks when the input has fewer splits than there are cores.

    Large inputs have far more splits than cores and pass through untouched.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
