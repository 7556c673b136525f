"""Deduplication over any distance in time.

Copies of a reading have the same event time, so they belong to the same hour, however
much later they arrive. Each stored hour has a Bloom filter. A batch asks the filters of
its hours; only keys that may be known are looked up, and only in their own hours. What
the stream keeps in memory is nothing; what it keeps on storage is one filter an hour.

Rows are stored in a folder for each day, sorted by hour, so that a batch with readings of
many hours does not leave a small file for each.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge.functions.predicates import all_of
from fleetgauge.functions.timeparts import hour_key
from fleetgauge.operators.bloom import FILTER_BITS, build_filters, filter_schema, maybe_known, merge_filters
from fleetgauge.operators.latest import IDENTITY, first_per_group, with_identity
from fleetgauge.streaming.stores import MergeStore

HOUR, DAY = "event_hour", "event_day"
# Rows without an event time are told apart by content, under an hour of their own.
NO_HOUR = "none"
# Hours that are named one by one when they are read; beyond it they are joined.
HOURS_AT_ONCE = 1000


def filter_store(base: str, bits: int = FILTER_BITS) -> MergeStore:
    return MergeStore(
        f"{base}/filters",
        filter_schema(HOUR),
        lambda rows: build_filters(with_identity(rows), HOUR, IDENTITY, bits),
        lambda filters: merge_filters(filters, HOUR),
    )


def stored_rows(spark: SparkSession, base: str, hours: Sequence[str] | None = None) -> DataFrame:
    """What the stream has kept, with ``event_hour`` and ``batch_id``; of the hours named, if any are.

    Only the folders of their days are listed, and of those only the row groups that hold them are read.
    """
    days = sorted({h[:8] for h in hours or ()})
    paths = [f"{base}/table/batch_id=*/{DAY}={day}" for day in days] or [f"{base}/table"]
    rows = spark.read.option("basePath", f"{base}/table").parquet(*paths).drop(DAY)
    rows = rows.withColumn("batch_id", F.col("batch_id").cast("bigint"))
    return rows.filter(F.col(HOUR).isin(*hours)) if hours else rows


def seen_batch(
    base: str, tiebreak: Sequence[str] = (), bits: int = FILTER_BITS, hours_at_once: int = HOURS_AT_ONCE
) -> Callable[[DataFrame, int], None]:
    """A callback that stores the rows of a batch that no batch before it has, under ``batch_id=N``.

    Rows need ``event_ts`` and ``collected_ts``. Of copies inside a batch the first collected
    stays. A batch that is run again looks at earlier ones only, so it finds what it found.
    """
    filters = filter_store(base, bits)

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        hour = F.coalesce(hour_key(F.col("event_ts")), F.lit(NO_HOUR))
        order = [F.col(c).asc_nulls_last() for c in ("collected_ts", *tiebreak)]
        rows = with_identity(batch.withColumn(HOUR, hour))
        rows = first_per_group(rows, [HOUR, *IDENTITY], [*order, F.xxhash64(*batch.columns)]).persist()
        try:
            maybe = maybe_known(rows, filters.states(spark, before=batch_id), HOUR, IDENTITY, bits)
            hours = [r[HOUR] for r in maybe.select(HOUR).distinct().limit(hours_at_once + 1).collect()]
            fresh = rows
            if hours:
                known = stored_rows(spark, base, hours if len(hours) <= hours_at_once else None)
                known = with_identity(known.filter(F.col("batch_id") < batch_id)).select(HOUR, *IDENTITY)
                copies = _joined(maybe, known, "left_semi")
                fresh = _joined(rows, copies, "left_anti")
            fresh = fresh.select(*batch.columns, HOUR, F.substring(HOUR, 1, 8).alias(DAY))
            folder = f"{base}/table/batch_id={batch_id}"
            dealt = fresh.hint("rebalance", DAY).sortWithinPartitions(DAY, HOUR)
            dealt.write.mode("overwrite").partitionBy(DAY).parquet(folder)
            # Read back: a row is in the filter if and only if it is in the table.
            kept = spark.read.schema(fresh.schema).parquet(folder)
            filters.store(kept.drop(DAY), batch_id)
        finally:
            rows.unpersist()

    return store


def _joined(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """On equal keys, null for null; the sides may come of each other."""
    each = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in (HOUR, *IDENTITY)]
    return left.alias("l").join(right.alias("r"), all_of(each), how)
