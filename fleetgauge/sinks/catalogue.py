"""Keep a table's registered partitions in step with its folders, both ways.

Folders are listed by tasks, one for each folder of the first level. Two anti joins with
what the catalogue has tell what to add and what to drop; nothing else is touched.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import islice
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ADD, DROP = "add", "drop"
# Partitions that one statement names.
STATEMENT = 200


def _first_level(spark: SparkSession, path: str, name: str) -> list[str]:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(
        spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}=*")
    )
    return sorted(f.getPath().toString() for f in found or [] if f.isDirectory())


def _below(levels: Sequence[str]):
    """Partition folders below the given ones that hold a file, whatever depth they are at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for folder in batch.column(0).to_pylist():
                store, inside = fs.FileSystem.from_uri(folder if "://" in folder else folder.replace("file:/", "file:///", 1))
                found = set()
                for item in store.get_file_info(fs.FileSelector(inside, recursive=True)):
                    if item.type != fs.FileType.File or item.base_name.startswith(("_", ".")):
                        continue
                    parts = item.path.split("/")[-len(levels) - 1 : -1]
                    if [p.partition("=")[0] for p in parts] == list(levels):
                        found.add("/".join(parts))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(sorted(found))], names=["partition"])

    return run


def listed_partitions(spark: SparkSession, path: str, layout: Sequence[str]) -> DataFrame:
    """``partition`` (``level=value/...``) of every folder of the layout that holds a file.

    The driver lists the first level only. The file system of ``path`` must be one that pyarrow
    reads, as tasks cannot ask Hadoop's.
    """
    first = _first_level(spark, path, layout[0])
    if not first:
        return spark.createDataFrame([], "partition string")
    tasks = min(len(first), spark.sparkContext.defaultParallelism * 4)
    folders = spark.createDataFrame([(f,) for f in first], "folder string").repartition(tasks)
    return folders.mapInArrow(_below(layout), "partition string")


def registered_partitions(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"SHOW PARTITIONS {table}")


def partition_changes(listed: DataFrame, registered: DataFrame) -> DataFrame:
    """``partition`` and ``action``: add what is listed only, drop what is registered only."""
    listed, registered = listed.select("partition").distinct(), registered.select("partition").distinct()
    more = listed.join(registered, "partition", "left_anti").withColumn("action", F.lit(ADD))
    less = registered.join(listed, "partition", "left_anti").withColumn("action", F.lit(DROP))
    return more.unionByName(less)


def _spec(partition: str) -> str:
    """``level='value', ...`` of a folder's name, in which special characters are escaped."""
    pairs = (level.partition("=") for level in partition.split("/"))
    quoted = ((name, unquote(value).replace("\\", "\\\\").replace("'", "\\'")) for name, _, value in pairs)
    return ", ".join(f"{name}='{value}'" for name, value in quoted)


def statements(table: str, path: str, changes: Iterator[tuple[str, str]]) -> Iterator[str]:
    """ALTER TABLE commands for (partition, action) rows that come grouped by action."""
    held: list[str] = []
    now = None

    def command() -> str:
        if now == ADD:
            named = " ".join(f"PARTITION ({_spec(p)}) LOCATION '{path.rstrip('/')}/{p}'" for p in held)
            return f"ALTER TABLE {table} ADD IF NOT EXISTS {named}"
        return f"ALTER TABLE {table} DROP IF EXISTS " + ", ".join(f"PARTITION ({_spec(p)})" for p in held)

    while part := list(islice(changes, STATEMENT)):
        for partition, action in part:
            if held and (action != now or len(held) == STATEMENT):
                yield command()
                held.clear()
            now = action
            held.append(partition)
    if held:
        yield command()


def reconcile(spark: SparkSession, table: str, path: str, layout: Sequence[str]) -> dict[str, int]:
    """Add and drop what differs; how many of each. Running it again changes nothing.

    Dropping a partition of an external table leaves its files alone. Changes pass through
    the driver a part at a time, as commands to the catalogue do.
    """
    listed = listed_partitions(spark, path, layout)
    changes = partition_changes(listed, registered_partitions(spark, table)).persist()
    try:
        counts = {ADD: 0, DROP: 0} | {r["action"]: r["count"] for r in changes.groupBy("action").count().collect()}
        for action in (ADD, DROP):
            rows = changes.filter(F.col("action") == action).toLocalIterator()
            for command in statements(table, path, ((r["partition"], r["action"]) for r in rows)):
                spark.sql(command)
    finally:
        changes.unpersist()
    return counts
