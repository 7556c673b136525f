"""Groups in tiles that a task can hold, and how a task reads them from its sorted stream."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession, most: int = 1 << 23) -> None:
    """Lower the bytes of rows that a Python task is handed at once, where the session allows more.

    A task holds a batch in several forms, and two tasks or more share an executor.
    """
    now = spark.conf.get(BATCH_BYTES).rstrip("b")
    if not now.isdigit() or int(now) > most:
        spark.conf.set(BATCH_BYTES, str(most))


@cache
def _trim():
    return getattr(ctypes.CDLL(None), "malloc_trim", lambda _: 0)


def give_back() -> None:
    """Return freed memory to the machine: a worker lives on, and the next stage is short of what it keeps."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


def tiles(members: DataFrame, group: Sequence[str], member: str, most: int) -> DataFrame:
    """Members of every group of two or more in tiles ``i``, ``j``: each pair of them meets in one.

    A group none of whose members has ``native`` true is left out, where there is such a column.

    A group with up to ``most`` of the column ``load`` has one tile; a larger one's members
    are dealt into parts, and every pair of parts is a tile. ``part`` is the member's own.
    Meant for narrow rows: what a task needs of its members is joined afterwards.
    """
    native = F.max("native") if "native" in members.columns else F.lit(True)
    sizes = members.groupBy(*group).agg(F.sum("load").alias("total"), F.count("*").alias("there"), native.alias("native"))
    sizes = sizes.filter("there > 1 and native")
    sizes = sizes.select(*group, F.ceil(F.col("total") / most).cast("int").alias("parts"))
    dealt = members.drop("load", "native").join(sizes, list(group))
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64(member, *group), F.col("parts")).cast("int"))
    meets = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda k: F.struct(F.least("part", k).alias("i"), F.greatest("part", k).alias("j")),
    )
    return dealt.withColumn("tile", F.explode(meets)).select("*", "tile.i", "tile.j").drop("tile", "parts")


def laid_out(rows: DataFrame, group: Sequence[str], member: str) -> DataFrame:
    """Rows sorted by group and tile, so that each tile is a run of its task's rows."""
    return rows.repartition(*group, "i", "j").sortWithinPartitions(*group, "i", "j", member)


def runs(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    """The stream cut where a key changes; equal keys must follow each other.

    Holds one group and one batch at most.
    """
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        turns = np.zeros(table.num_rows - 1, dtype=bool)
        for key in keys:
            values = table.column(key).to_numpy()
            turns |= values[1:] != values[:-1]
        edges = [0, *(np.flatnonzero(turns) + 1).tolist()]
        table = table.combine_chunks()
        for low, high in zip(edges[:-1], edges[1:]):
            yield table.slice(low, high - low)
        rest = table.slice(edges[-1])
    if rest is not None:
        yield rest


def binaries(column: pa.ChunkedArray, dtype: str) -> list[np.ndarray]:
    """An array for each row of a binary column."""
    column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    column = column.cast(pa.large_binary())
    bounds = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    return [data[low:high].view(dtype) for low, high in zip(bounds[:-1], bounds[1:])]
