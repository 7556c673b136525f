"""Per-device averages, and the hourly text report.

Every aggregate here combines inside each input partition before the shuffle, so a
device with many readings sends a handful of rows, not its history.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge.functions.predicates import valid_range
from fleetgauge.functions.timeparts import parse_time
from fleetgauge.rules import REPORT_HEADER, REPORT_METRICS
from fleetgauge.schema import KEY, METRICS


def mean_known(column: str) -> Column:
    """Mean that skips NaN as well as NULL."""
    return F.avg(F.nanvl(F.col(column), F.lit(None).cast("double")))


def device_batch_stats(df: DataFrame) -> DataFrame:
    """Averages per device over a batch, its newest time, and its fault rate in percent."""
    return df.groupBy(KEY).agg(
        F.max(parse_time("time")).alias("latest_time"),
        *[F.avg(c).alias(c) for c in METRICS],
        (F.avg(F.col("isFail").cast("int")) * 100).alias("fail_rate"),
    )


def hourly_device_mean(df: DataFrame) -> DataFrame:
    """Mean of each metric per device and hour, for every device and hour at once."""
    return df.groupBy(KEY, "ymdh").agg(*[mean_known(c).alias(f"{c}_avg") for c in METRICS])


def round_half_even(column: Column, digits: int = 2) -> Column:
    """Scale, round ties to the even whole number, scale back.

    A sum's last bits depend on the order of its rows; they are cleared first, so that
    a tie is a tie in every run.
    """
    scale = 10.0**digits
    return F.rint(F.round(column * scale, 6)) / scale


def hourly_device_report(means: DataFrame) -> DataFrame:
    """One text block per device and hour, with the date, hour and device it is filed under."""
    day, hour = F.substring("ymdh", 1, 8), F.substring("ymdh", 9, 2)
    lines = [F.format_string(REPORT_HEADER, day, hour)]
    for name in REPORT_METRICS:
        shown = F.coalesce(round_half_even(F.col(f"{name}_avg")).cast("string"), F.lit("nan"))
        lines.append(F.concat(F.lit(f"{name}_avg : "), shown))
    return means.select(
        day.alias("ymd"),
        hour.alias("hh"),
        F.format_string("%02d", F.col(KEY)).alias("device"),
        F.concat_ws("\n", *lines).alias("value"),
    )


def data_quality_score(df: DataFrame) -> DataFrame:
    """Share of a device's readings that are certainly valid, in percent."""
    return df.groupBy(KEY).agg(
        F.count("*").alias("readings"),
        (F.count_if(valid_range()) * 100.0 / F.count("*")).alias("quality_score"),
    )
