"""Outlier bounds from quantile sketches that are stored per device and hour.

A sketch holds a bounded sample of an hour's values with weights. Sketches merge, so the
bounds of any span of hours, of one device or of the fleet, come from rows already stored
and no reading is read again. A stream adds an hour's late readings as one more sketch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge.operators.quantiles import known
from fleetgauge.rules import IQR_THRESHOLD
from fleetgauge.schema import KEY, METRICS

# Size of a sketch. The rank of a quantile it gives is off by at most RANK_ERROR of the
# number of values, at 99 of 100; merging keeps the bound.
SKETCH_SIZE = 400
RANK_ERROR = 0.01
QUARTILES = (0.25, 0.75)
SKETCHES = f"{KEY} int, ymdh string, " + ", ".join(f"{c}_sketch binary" for c in METRICS)


def hour_sketches(df: DataFrame, columns: Sequence[str] = METRICS, size: int = SKETCH_SIZE) -> DataFrame:
    """A sketch of each metric's known values, per device and hour; NULL without any."""
    sketches = [
        F.when(F.count(known(c)) > 0, F.kll_sketch_agg_double(known(c), F.lit(size))).alias(f"{c}_sketch")
        for c in columns
    ]
    return df.groupBy(KEY, "ymdh").agg(*sketches)


def merge_sketches(
    sketches: DataFrame, by: Sequence[str] = (KEY, "ymdh"), columns: Sequence[str] = METRICS
) -> DataFrame:
    merged = [
        F.when(F.count(f"{c}_sketch") > 0, F.kll_merge_agg_double(f"{c}_sketch")).alias(f"{c}_sketch")
        for c in columns
    ]
    return sketches.groupBy(*by).agg(*merged)


def _quantile(sketch: str, probability: float) -> Column:
    return F.kll_sketch_get_quantile_double(sketch, F.lit(probability))


def sketched_bounds(
    sketches: DataFrame,
    hours: Sequence[str] | None = None,
    by: Sequence[str] = (),
    columns: Sequence[str] = METRICS,
    threshold: float = IQR_THRESHOLD,
) -> DataFrame:
    """Per metric (and ``by``): ``readings``, ``lowest``, ``highest``, ``q1``, ``q3`` and the bounds.

    ``hours`` narrows the span and prunes a table stored by hour. Counts and extremes are exact, quartiles
    within RANK_ERROR. A metric without a known value has no row.
    """
    chosen = sketches if hours is None else sketches.filter(F.col("ymdh").isin(*hours))
    merged = merge_sketches(chosen, by, columns)
    long = merged.unpivot(list(by), [f"{c}_sketch" for c in columns], "metric", "sketch").filter("sketch is not null")
    cuts = long.select(
        *by,
        F.regexp_replace("metric", "_sketch$", "").alias("metric"),
        F.kll_sketch_get_n_double("sketch").alias("readings"),
        *[_quantile("sketch", p).alias(c) for p, c in zip((0.0, 1.0, *QUARTILES), ("lowest", "highest", "q1", "q3"))],
    )
    reach = (F.col("q3") - F.col("q1")) * threshold
    return cuts.withColumns({"lower_bound": F.col("q1") - reach, "upper_bound": F.col("q3") + reach})


def flag_by_bounds(df: DataFrame, bounds: DataFrame, columns: Sequence[str] = METRICS) -> DataFrame:
    """Add ``<metric>_outlier`` by stored bounds, on a batch or a stream.

    ``bounds`` has a row for each metric; a metric without one, and a missing value, is normal.
    """
    rows = {r["metric"]: (r["lower_bound"], r["upper_bound"]) for r in bounds.filter(F.col("metric").isin(*columns)).collect()}
    flags = {}
    for c in columns:
        low, high = (F.lit(v).cast("double") for v in rows.get(c, (None, None)))
        flags[f"{c}_outlier"] = F.when((F.col(c) < low) | (F.col(c) > high), F.lit("FLAG")).otherwise(F.lit("NORMAL"))
    return df.withColumns(flags)
