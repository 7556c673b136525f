"""Gauge snapshots in long form: metric name, device label, value."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetgauge.operators.latest import is_recent, latest_per_route, newest
from fleetgauge.rules import (
    BATCH_METRIC_NAMES,
    FAMILY_OF_ROUTE,
    METRIC_NAME,
    RAW_FAMILY,
    RETENTION_MINUTES,
)
from fleetgauge.schema import KEY, METRICS


def to_long(df: DataFrame, ids: Sequence[str], metrics: Sequence[str] = METRICS) -> DataFrame:
    """One row per metric that has a value."""
    wide = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in metrics])
    return wide.unpivot(list(ids), list(metrics), "metric", "value").filter(
        F.col("value").isNotNull()
    )


def families(per_route: DataFrame, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Winners per route to winners per gauge family.

    A winner stands for its route's family while it is recent, and the newest winner of
    a device also for the raw family, which spans all routes and ages. Both are read
    off the winners, a few rows per device, so the readings are scanned once.
    """
    place = F.row_number().over(Window.partitionBy(KEY).orderBy(*newest(tiebreak)))
    named = F.create_map(*[F.lit(x) for pair in FAMILY_OF_ROUTE.items() for x in pair])
    own = F.when(F.col("recent"), F.try_element_at(named, F.col("route")))
    raw = F.when(F.col("_place") == 1, F.lit(RAW_FAMILY))
    return (
        per_route.withColumn("_place", place)
        .withColumn("family", F.explode(F.array_compact(F.array(own, raw))))
        .drop("_place")
    )


def metric_snapshot(
    df: DataFrame,
    tiebreak: Sequence[str] = (),
    as_of: datetime | str | Column | None = None,
    minutes: int = RETENTION_MINUTES,
) -> DataFrame:
    """Latest value of every gauge in all four families, from one scan of the readings.

    With ``as_of`` the routed families hold only recent readings. The result replaces
    the previous snapshot, so a device that falls silent disappears.
    """
    fresh = F.lit(True) if as_of is None else F.coalesce(is_recent(as_of, minutes), F.lit(False))
    keyed = df.filter(F.col(KEY).isNotNull()).withColumn("recent", fresh)
    winners = families(latest_per_route(keyed, tiebreak, ("recent", KEY)), tiebreak)
    prefix, suffix = METRIC_NAME.split("{family}")
    lead = suffix.split("{metric}")[0]
    return to_long(winners, ["family", KEY]).select(
        F.concat(F.lit(prefix), "family", F.lit(lead), "metric").alias("metric"),
        F.col(KEY).cast("string").alias("device_id"),
        "value",
    )


def batch_gauges(stats: DataFrame, names: Mapping[str, str] = BATCH_METRIC_NAMES) -> DataFrame:
    """Per-batch device statistics as gauges; a device in the batch is online."""
    wide = stats.withColumn("online", F.lit(1.0))
    present = [c for c in names if c in wide.columns]
    named = F.create_map(*[F.lit(x) for c in present for x in (c, names[c])])
    return to_long(wide, [KEY], present).select(
        F.element_at(named, F.col("metric")).alias("metric"),
        F.col(KEY).cast("string").alias("device_id"),
        "value",
    )


def exposition_lines(snapshot: DataFrame) -> DataFrame:
    """The snapshot as ``name{device_id="7"} value`` text lines."""
    return snapshot.select(
        F.format_string(
            '%s{device_id="%s"} %s', "metric", "device_id", F.col("value").cast("string")
        ).alias("value")
    )
