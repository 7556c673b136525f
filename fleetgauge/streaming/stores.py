"""Aggregates of micro-batches that add up: stored by batch, folded together, read as one.

A closed hour is never final here. What arrives late adds to the stored states of its hour,
and whoever reads them next sees the corrected figure. A batch that is run again replaces
its own states, so a replay changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


def numbered_folders(spark: SparkSession, pattern: str) -> list[int]:
    """N of every finished folder ``name=N`` that the pattern names, ascending.

    A folder is finished when its writer has left the mark of success in it.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{pattern}/_SUCCESS")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(int(f.getPath().getParent().getName().partition("=")[2]) for f in found or [])


def remove_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@dataclass(frozen=True)
class MergeStore:
    """States in ``base``: ``make`` turns rows into states, ``merge`` states into fewer of the same columns.

    ``merge`` must give the same whatever states were merged before.
    """

    base: str
    schema: str
    make: Callable[[DataFrame], DataFrame]
    merge: Callable[[DataFrame], DataFrame]

    def store(self, batch: DataFrame, batch_id: int) -> None:
        """The callback of a stream."""
        self.make(batch).write.mode("overwrite").parquet(f"{self.base}/batches/batch_id={batch_id}")

    def _parts(self, spark: SparkSession, before: int | None = None) -> tuple[int, list[int]]:
        """The newest fold, and the batches it does not hold; only those ``before`` a batch."""
        folds = [n for n in numbered_folders(spark, f"{self.base}/folded/through=*") if before is None or n < before]
        newest = max(folds, default=-1)
        batches = numbered_folders(spark, f"{self.base}/batches/batch_id=*")
        return newest, [n for n in batches if n > newest and (before is None or n < before)]

    def states(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        """All states, merged; those of batches ``before`` one, where given."""
        newest, batches = self._parts(spark, before)
        paths = [f"{self.base}/batches/batch_id={n}" for n in batches]
        paths += [f"{self.base}/folded/through={newest}"] if newest >= 0 else []
        if not paths:
            return self.merge(spark.createDataFrame([], self.schema))
        return self.merge(spark.read.schema(self.schema).parquet(*paths))

    def fold(self, spark: SparkSession) -> None:
        """Merge all batches so far into one table; what it replaces stays until it is retired.

        A batch that is run again after it was folded is not counted a second time.
        """
        newest, batches = self._parts(spark)
        if batches:
            self.states(spark).write.mode("overwrite").parquet(f"{self.base}/folded/through={batches[-1]}")

    def retire(self, spark: SparkSession) -> None:
        """Delete what the newest fold holds; no reader of older listings may be running."""
        newest, _ = self._parts(spark)
        for n in numbered_folders(spark, f"{self.base}/batches/batch_id=*"):
            if n <= newest:
                remove_folder(spark, f"{self.base}/batches/batch_id={n}")
        for n in numbered_folders(spark, f"{self.base}/folded/through=*"):
            if n < newest:
                remove_folder(spark, f"{self.base}/folded/through={n}")
