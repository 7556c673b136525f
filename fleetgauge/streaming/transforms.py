"""Streaming forms of the operators, each with bounded state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgauge.functions.predicates import absent
from fleetgauge.functions.timeparts import with_hour_key, with_times
from fleetgauge.operators.latest import IDENTITY, with_identity
from fleetgauge.operators.routing import with_route
from fleetgauge.operators.rollup import mean_known
from fleetgauge.schema import KEY, METRICS

DELAY = "10 minutes"


def dedup_stream(readings: DataFrame, delay: str = DELAY, spread: int = 1) -> DataFrame:
    """One row per event time and device among those that arrive within ``delay``.

    The watermark runs on arrival, the time of the micro-batch, which is the same when a
    batch is run again. No device's clock can push it, so no reading is ever late: one
    that is hours old or from the future is kept like any other. Copies that arrive
    further apart than ``delay`` are both kept; compaction settles them by hour.

    Rows without an event time would all share one key. They are told apart by their
    whole content instead, so that none is taken for a copy of another.

    Where one reading is sent over and over, ``spread`` above 1 thins its copies out in
    so many groups by where they were read, before the rest meets in one task.
    """
    keys = list(IDENTITY)
    marked = with_identity(readings).withColumn("_arrived", F.current_timestamp())
    marked = marked.withWatermark("_arrived", delay)
    if spread > 1:
        marked = marked.withColumn(
            "_spread", F.pmod(F.spark_partition_id(), F.lit(spread))
        ).dropDuplicatesWithinWatermark([*keys, "_spread"])
    return marked.dropDuplicatesWithinWatermark(keys).select(*readings.columns)


def route_stream(
    readings: DataFrame, delay: str | None = DELAY, hour_source: str = "collected_ts"
) -> DataFrame:
    """Parsed readings to routed rows. The same plan serves batch input with no delay.

    A row that cannot be placed, for want of a device or of the time the hour is taken
    from or of its event time, is routed to ``reject``.
    """
    timed = with_hour_key(with_times(readings), hour_source)
    if delay is not None:
        timed = dedup_stream(timed, delay)
    return with_route(timed, reject=absent(("event_ts", "ymdh", KEY)))


def hourly_mean_stream(
    readings: DataFrame, delay: str = DELAY, column: str = "collected_ts"
) -> DataFrame:
    """Mean of each metric per device and hour, emitted once the hour is closed.

    An hour closes by the collector's clock; what is collected after that is not in it. The
    batch means over the compacted table count every reading.
    """
    return (
        readings.withWatermark(column, delay)
        .groupBy(F.window(column, "1 hour").alias("hour"), KEY)
        .agg(*[mean_known(c).alias(f"{c}_avg") for c in METRICS])
        .select(KEY, F.date_format("hour.start", "yyyyMMddHH").alias("ymdh"), *[f"{c}_avg" for c in METRICS])
    )


def latest_stream(readings: DataFrame, *tiebreak: str) -> DataFrame:
    """Newest reading per device, kept up to date; state is one row per device."""
    timed = readings.filter(F.col("event_ts").isNotNull() & F.col(KEY).isNotNull())
    kept = [c for c in ("event_ts", "collected_ts", *tiebreak, "time", *METRICS)]
    order = F.struct("event_ts", "collected_ts", *tiebreak)
    return (
        timed.groupBy(KEY).agg(F.max_by(F.struct(*kept), order).alias("latest")).select(KEY, "latest.*")
    )
