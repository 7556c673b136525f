"""Hourly means from stored sums and counts, so that late readings still count."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgauge.operators.quantiles import known
from fleetgauge.schema import KEY, METRICS

PARTIALS = f"{KEY} int, ymdh string, " + ", ".join(f"{c}_sum double, {c}_count bigint" for c in METRICS)


def hour_partials(df: DataFrame, columns: Sequence[str] = METRICS) -> DataFrame:
    """Sum and count of each metric's known values, per device and hour."""
    sums = [agg for c in columns for agg in (F.sum(known(c)).alias(f"{c}_sum"), F.count(known(c)).alias(f"{c}_count"))]
    return df.groupBy(KEY, "ymdh").agg(*sums)


def merge_partials(partials: DataFrame, columns: Sequence[str] = METRICS) -> DataFrame:
    sums = [F.sum(f"{c}_{part}").alias(f"{c}_{part}") for c in columns for part in ("sum", "count")]
    return partials.groupBy(KEY, "ymdh").agg(*sums)


def partial_means(partials: DataFrame, columns: Sequence[str] = METRICS) -> DataFrame:
    """``<metric>_avg`` of each device and hour, as ``hourly_device_mean`` over all its readings.

    NULL where no reading had a known value.
    """
    means = [(F.col(f"{c}_sum") / F.nullif(F.col(f"{c}_count"), F.lit(0))).alias(f"{c}_avg") for c in columns]
    return merge_partials(partials, columns).select(KEY, "ymdh", *means)
