"""Which devices of the fleet reported, and which are online."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge.operators.latest import is_recent
from fleetgauge.rules import FIRST_DEVICE, LAST_DEVICE, RETENTION_MINUTES
from fleetgauge.schema import KEY


def fleet(spark: SparkSession, first: int = FIRST_DEVICE, last: int = LAST_DEVICE) -> DataFrame:
    return spark.range(first, last + 1, numPartitions=1).select(F.col("id").cast("int").alias(KEY))


def _of_fleet(df: DataFrame, first: int, last: int) -> DataFrame:
    """The fleet's own readings; grouped by device, never more rows than the fleet has."""
    return df.filter(F.col(KEY).between(first, last))


def device_coverage(
    df: DataFrame, first: int = FIRST_DEVICE, last: int = LAST_DEVICE
) -> DataFrame:
    """Readings per fleet device, zero included."""
    counts = _of_fleet(df, first, last).groupBy(KEY).agg(F.count("*").alias("readings"))
    readings = F.coalesce("readings", F.lit(0).cast("bigint"))
    return (
        fleet(df.sparkSession, first, last)
        .join(counts, KEY, "left")
        .select(KEY, readings.alias("readings"), (readings > 0).alias("covered"))
    )


def missing_devices(
    df: DataFrame, first: int = FIRST_DEVICE, last: int = LAST_DEVICE
) -> DataFrame:
    """Fleet devices without a single reading."""
    seen = _of_fleet(df, first, last).select(KEY).distinct()
    return fleet(df.sparkSession, first, last).join(seen, KEY, "left_anti")


def device_online(
    df: DataFrame,
    as_of: datetime | str | Column,
    minutes: int = RETENTION_MINUTES,
    first: int = FIRST_DEVICE,
    last: int = LAST_DEVICE,
    column: str = "collected_ts",
) -> DataFrame:
    """1 for a device heard from within ``minutes`` before ``as_of``, else 0."""
    seen = _of_fleet(df, first, last).groupBy(KEY).agg(F.max(column).alias("last_seen"))
    online = F.when(is_recent(as_of, minutes, "last_seen"), 1).otherwise(0)
    return (
        fleet(df.sparkSession, first, last)
        .join(seen, KEY, "left")
        .select(KEY, "last_seen", online.alias("online"))
    )
