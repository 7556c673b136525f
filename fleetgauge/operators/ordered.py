"""A per-device order that no single task has to hold.

A window partitioned by device alone puts a device's whole history into one task,
so one chatty device stalls the job. Here the rows are range-partitioned on the
full order instead, which cuts a hot device into as many splits as it needs, and
frames that cross a cut are served from small summaries of the neighbouring splits.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetgauge.schema import KEY
from fleetgauge.session import materialise

POSITION, SPLIT, HALO, CHAIN = "_position", "_split", "_halo", "_chain"
SPLIT_BITS = 16  # rows per split, as a power of two
_ROW_BITS = 33  # a row's number within its partition, in monotonically_increasing_id


def in_order(
    df: DataFrame, order: Sequence[str], key: str = KEY, split_bits: int = SPLIT_BITS
) -> DataFrame:
    """Rows in ``(key, *order)`` order with their chain, global position and split.

    The chain is the key, or NULL for a row without a key or time: such a row has no
    place in any order, is in no other row's frame, and is kept all the same.

    Positions grow by one inside a sorted partition and jump to the next one, so their
    high bits name a run of at most 65,536 consecutive rows: the split. No group of a
    later pass is larger than that, whatever a device or partition holds.

    Sampling picks the cuts between partitions, so they are fixed by writing the sorted
    rows to the shared folder; every later pass then agrees on them. Rows that tie on
    the whole order are told apart by content and, if exact copies, by arrival, so even
    a group of copies is spread out.
    """
    ranked = df.withColumns(
        {
            CHAIN: F.when(F.col(order[0]).isNotNull(), F.col(key)),
            "_content": F.xxhash64(*df.columns),
            "_arrival": F.monotonically_increasing_id(),
        }
    )
    keys = [F.col(c).asc_nulls_first() for c in (CHAIN, *order, "_content", "_arrival")]
    ranked = ranked.orderBy(*keys).drop("_content", "_arrival")
    placed = ranked.withColumn(POSITION, F.monotonically_increasing_id())
    return materialise(placed.withColumn(SPLIT, F.shiftright(POSITION, split_bits)), "ordered")


def split_window(after: bool = False):
    return Window.partitionBy(SPLIT, CHAIN).orderBy(F.col(POSITION).desc() if after else POSITION)


def chain_window():
    """Over summaries of the splits: one row per split and chain."""
    return Window.partitionBy(CHAIN).orderBy(SPLIT).rowsBetween(Window.unboundedPreceding, -1)


def with_halo(
    ordered: DataFrame, rows: int, columns: Sequence[str], split_bits: int = SPLIT_BITS
) -> DataFrame:
    """Give every (split, chain) group the ``rows`` rows that precede it elsewhere.

    The borrowed rows are marked, so that a frame of up to ``rows`` preceding rows is
    complete inside each group and the marked rows are dropped afterwards. They carry
    ``columns`` only; the rest is NULL. Borrowing looks at the last rows of each split,
    found by position alone, so neither a sort nor a shuffle of the table is needed.
    """
    position, last = F.col(POSITION), (1 << split_bits) - 1
    partition = F.shiftright(POSITION, _ROW_BITS)
    groups = (
        ordered.filter(F.col(CHAIN).isNotNull())
        .groupBy(SPLIT, CHAIN)
        .agg(F.count("*").alias("_n"), F.min(POSITION).alias("_first"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(chain_window()), F.lit(0)))
    )
    wanted = groups.filter("_start > 0").select(
        CHAIN,
        F.col(SPLIT).alias("_target"),
        F.explode(
            F.sequence(F.greatest(F.lit(0), F.col("_start") - rows), F.col("_start") - 1)
        ).alias("_index"),
    )
    # One row per sorted partition: never more than the shuffle has partitions.
    ends = ordered.groupBy(partition.alias("_partition")).agg(F.max(POSITION).alias("_end"))
    tails = (
        ordered.select(CHAIN, SPLIT, POSITION, *columns, partition.alias("_partition"))
        .join(F.broadcast(ends), "_partition")
        .filter((position.bitwiseAND(last) > last - rows) | (position > F.col("_end") - rows))
        .join(groups, [SPLIT, CHAIN])
        .withColumn("_index", F.col("_start") + position - F.col("_first"))
    )
    halo = tails.join(wanted, [CHAIN, "_index"]).select(
        CHAIN, F.col("_target").alias(SPLIT), POSITION, *columns, F.lit(True).alias(HALO)
    )
    return ordered.withColumn(HALO, F.lit(False)).unionByName(halo, allowMissingColumns=True)


# Totals over the rows before or after a row, and how two of them are put together.
TOTALS = {
    "sum": (F.sum, lambda a, b: F.coalesce(a + b, a, b)),
    "min": (F.min, F.least),
    "max": (F.max, F.greatest),
}


def carried(
    ordered: DataFrame, values: Mapping[str, Column], total: str, after: bool = False
) -> DataFrame:
    """Add for each row the ``total`` of ``values`` over all rows of its chain before it, or ``after`` it.

    A split is looked at by itself, and one row for each split and chain tells what the
    other splits hold. NULL where there is no such row. Rows after a row are looked at from
    the last one backwards: a frame that grows is added to, one that shrinks is summed anew
    for every row.
    """
    of, both = TOTALS[total]
    edge = (Window.unboundedPreceding, -1)
    inside = split_window(after).rowsBetween(*edge)
    beyond = Window.partitionBy(CHAIN).orderBy(F.col(SPLIT).desc() if after else SPLIT).rowsBetween(*edge)
    placed = ordered.filter(F.col(CHAIN).isNotNull())
    splits = placed.groupBy(SPLIT, CHAIN).agg(*[of(v).alias(f"_{c}") for c, v in values.items()])
    splits = splits.select(SPLIT, CHAIN, *[of(f"_{c}").over(beyond).alias(f"_{c}") for c in values])
    rows = placed.withColumns({c: of(v).over(inside) for c, v in values.items()}).join(splits, [SPLIT, CHAIN])
    rows = rows.withColumns({c: both(F.col(c), F.col(f"_{c}")) for c in values})
    return rows.drop(*[f"_{c}" for c in values])
