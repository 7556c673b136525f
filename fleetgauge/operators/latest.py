"""Newest reading per device, recency, and deduplication.

All of these keep the first row of a group. Spark cuts each group to that row inside
every input partition (``WindowGroupLimit``) before it shuffles, so at most one row
per device and partition travels, however many readings a device has.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetgauge.functions.predicates import route_of
from fleetgauge.functions.timeparts import as_instant
from fleetgauge.rules import RETENTION_MINUTES
from fleetgauge.schema import KEY

RECENCY = ("event_ts", "collected_ts")


def first_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column]) -> DataFrame:
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def newest(tiebreak: Sequence[str] = ()) -> list[Column]:
    """Parsed time decides, not its text; ties fall to collection time, then an id."""
    return [F.col(c).desc_nulls_last() for c in (*RECENCY, *tiebreak)]


def latest_per_device(
    df: DataFrame, tiebreak: Sequence[str] = (), key: str = KEY
) -> DataFrame:
    """Rows without a usable event time cannot be the latest."""
    return first_per_group(df.filter(F.col("event_ts").isNotNull()), [key], newest(tiebreak))


def latest_per_route(
    df: DataFrame, tiebreak: Sequence[str] = (), within: Sequence[str] = (KEY,)
) -> DataFrame:
    """Newest row per route and device, for all routes from one scan."""
    routed = df.filter(F.col("event_ts").isNotNull()).withColumn("route", route_of())
    return first_per_group(routed, ["route", *within], newest(tiebreak))


def is_recent(
    as_of: datetime | str | Column,
    minutes: int = RETENTION_MINUTES,
    column: str = "collected_ts",
) -> Column:
    return F.col(column) >= as_instant(as_of) - F.make_dt_interval(mins=F.lit(minutes))


def recent(
    df: DataFrame,
    as_of: datetime | str | Column,
    minutes: int = RETENTION_MINUTES,
    column: str = "collected_ts",
) -> DataFrame:
    """Readings collected within ``minutes`` before ``as_of``."""
    return df.filter(is_recent(as_of, minutes, column))


# What makes two rows copies of one reading, on a batch and on a stream alike.
IDENTITY = ("event_ts", KEY, "_alone")


def with_identity(df: DataFrame) -> DataFrame:
    """Add ``_alone``: NULL, or the whole content of a row without an event time.

    Without it all of a device's rows that have no time would be copies of each other.
    """
    content = F.to_json(F.struct(*[c for c in df.columns if c != "batch_id"]))
    return df.withColumn("_alone", F.when(F.col("event_ts").isNull(), content))


def dedup_readings(df: DataFrame, tiebreak: Sequence[str] = ()) -> DataFrame:
    """One row per event time and device, the first collected; rows without a time by their content."""
    order = [F.col(c).asc_nulls_last() for c in ("collected_ts", *tiebreak)]
    return first_per_group(with_identity(df), IDENTITY, order).drop("_alone")
