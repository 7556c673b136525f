"""Dashboard panels as queries over readings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge.functions.timeparts import as_instant
from fleetgauge.operators.metrics import to_long
from fleetgauge.rules import PANEL_LIMITS, RETENTION_MINUTES
from fleetgauge.schema import KEY, METRICS

ALL_DEVICES = ".*"


def select_devices(df: DataFrame, pattern: str = ALL_DEVICES) -> DataFrame:
    """Device selector: the pattern must match the whole label."""
    if pattern == ALL_DEVICES:
        return df.filter(F.col(KEY).isNotNull())
    return df.filter(F.col(KEY).cast("string").rlike(f"^(?:{pattern})$"))


def panel_series(
    df: DataFrame,
    as_of: datetime | str | Column,
    pattern: str = ALL_DEVICES,
    minutes: int = RETENTION_MINUTES,
    metrics: Sequence[str] = METRICS,
) -> DataFrame:
    """Each metric over the panel's time range, one point per reading."""
    until = as_instant(as_of)
    since = until - F.make_dt_interval(mins=F.lit(minutes))
    points = select_devices(df, pattern).filter(F.col("event_ts").between(since, until))
    return to_long(points, ["event_ts", KEY], metrics)



def _newest_known(df: DataFrame, group: Sequence[str | Column], tiebreak: Sequence[str]) -> DataFrame:
    order = F.struct("event_ts", "collected_ts", *tiebreak)
    return df.groupBy(*group).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in METRICS]
    )


def panel_series_sampled(
    df: DataFrame, every: str = "1 minute", tiebreak: Sequence[str] = ()
) -> DataFrame:
    """Last known value per device, metric and sampling interval.

    Aggregates all metrics of an interval in one wide row and only then goes long, so
    the shuffle carries one row per device and interval rather than six.
    """
    timed = df.filter(F.col("event_ts").isNotNull() & F.col(KEY).isNotNull())
    sampled = _newest_known(
        timed.withColumn("sampled_at", F.window("event_ts", every)["start"]),
        [KEY, "sampled_at"],
        tiebreak,
    )
    return to_long(sampled, [KEY, "sampled_at"])


def panel_legend(df: DataFrame, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Last known value per device and metric, largest first within a metric."""
    timed = df.filter(F.col("event_ts").isNotNull() & F.col(KEY).isNotNull())
    return (
        to_long(_newest_known(timed, [KEY], tiebreak), [KEY])
        .withColumnRenamed("value", "last_value")
        .orderBy("metric", F.col("last_value").desc(), KEY)
    )


def threshold_state(points: DataFrame, limits: Mapping[str, float] = PANEL_LIMITS) -> DataFrame:
    """Colour of a point: red below zero, green from zero, red from the metric's limit."""
    limit = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])
    value = F.col("value")
    red = (value < 0) | (value >= F.element_at(limit, F.col("metric")))
    return points.withColumn("state", F.when(red, "red").otherwise("green"))


def device_labels(df: DataFrame) -> DataFrame:
    """Distinct device labels in text order, for the picker."""
    return (
        df.filter(F.col(KEY).isNotNull())
        .select(F.col(KEY).cast("string").alias("device_id"))
        .distinct()
        .orderBy("device_id")
    )
