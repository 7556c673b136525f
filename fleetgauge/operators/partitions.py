"""Which partitions a batch touches and which a table already has."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgauge.schema import KEY

# Folder names that carry a partition's device and hour, in any order of levels.
DEVICE_FOLDER = rf"(?:^|/){KEY}=(\d+)(?:/|$)"
HOUR_FOLDER = r"(?:^|/)ymdh=(\d+)(?:/|$)"
CALENDAR_KEYS = ("year", "month", "day", "hour", KEY)


def distinct_partitions(df: DataFrame, keys: Sequence[str] = CALENDAR_KEYS) -> DataFrame:
    return df.select(*keys).distinct()


def partition_inventory(
    paths: DataFrame, column: str = "path", device: str = DEVICE_FOLDER, hour: str = HOUR_FOLDER
) -> DataFrame:
    """Device and hour of every partition folder named in ``paths``, sorted."""
    path = F.col(column)
    return (
        paths.filter(path.rlike(device) & path.rlike(hour))
        .select(
            F.regexp_extract(path, device, 1).cast("int").alias(KEY),
            F.regexp_extract(path, hour, 1).alias("ymdh"),
        )
        .distinct()
        .orderBy(KEY, "ymdh")
    )
