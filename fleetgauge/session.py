"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution merges small shuffle partitions by their real bytes; the initial
# count, a few times the cores, is the deployment's to set.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # State of streams off the heap; timers need this store.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}
# Shuffle partitions for each core, where the deployment names no number: adaptive
# execution merges what is small, but cannot make more than there are.
PARTITIONS_A_CORE = 4
SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"


def build_session(app: str = "fleetgauge", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if SHUFFLE_PARTITIONS not in conf and spark.sparkContext.getConf().get(SHUFFLE_PARTITIONS) is None:
        cores = spark.sparkContext.defaultParallelism
        spark.conf.set(SHUFFLE_PARTITIONS, max(200, PARTITIONS_A_CORE * cores))
    return spark


def use_utc(spark: SparkSession) -> SparkSession:
    """Hour keys are read from the session zone, so every job pins it."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="fleetgauge-")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    A machine-local folder is made only for a local master, where driver and
    executors are one process.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return _local_folder()


_scope: ContextVar[str | None] = ContextVar("scratch folder", default=None)


def scratch_path(spark: SparkSession, label: str) -> str:
    parent = _scope.get() or os.path.join(shared_folder(spark), "fleetgauge")
    return os.path.join(parent, f"{label}-{uuid.uuid4().hex}")


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the scratch tables made inside once their results are written."""
    folder = scratch_path(spark, "scope")
    token = _scope.set(folder)
    try:
        yield
    finally:
        _scope.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_at_end(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder when the session's process ends, if nothing did before."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)


# A task that writes scratch rows holds this many bytes of them, not the 128 MB of a final table.
SCRATCH_ROW_GROUP = 32 << 20


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage in a way that survives lost executors, and, unlike an RDD
    checkpoint, stays columnar: later passes read only the columns they need.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.option("parquet.block.size", SCRATCH_ROW_GROUP).parquet(path)
    drop_at_end(df.sparkSession, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
