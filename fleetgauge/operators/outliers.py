"""Outlier flags per metric: interquartile, z-score, and rolling interquartile.

Bounds are rounded to six decimals before the comparison, so that the last bit of a
float sum cannot flip a flag between runs or partitionings.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge.operators.ordered import CHAIN, HALO, SPLIT_BITS, in_order, with_halo
from fleetgauge.operators.quantiles import exact_quantiles, known
from fleetgauge.operators.rolling import rolling_quantiles
from fleetgauge.rules import IQR_THRESHOLD, ROLLING_ROWS, Z_LIMITS
from fleetgauge.schema import KEY, METRICS

QUARTILES = (0.25, 0.75)
_DECIMALS = 6


def _flag(outlying: Column) -> Column:
    """A missing value or bound is not an outlier; NaN is above every bound."""
    return F.when(outlying, F.lit("FLAG")).otherwise(F.lit("NORMAL"))


def _outside(value: Column, q1: Column, q3: Column, threshold: float) -> Column:
    reach = (q3 - q1) * threshold
    return (value < F.round(q1 - reach, _DECIMALS)) | (value > F.round(q3 + reach, _DECIMALS))


def quartiles(
    df: DataFrame, columns: Sequence[str] = METRICS, relative_error: float | None = None
) -> dict[str, list[float | None]]:
    """First and third quartile per metric: exact, or one sketch pass within the error."""
    if relative_error is None:
        return exact_quantiles(df, columns, QUARTILES)
    accuracy = max(1, round(1 / relative_error))
    row = df.agg(
        *[F.percentile_approx(known(c), list(QUARTILES), accuracy).alias(c) for c in columns]
    ).first()
    return {c: row[c] or [None, None] for c in columns}


def outlier_bounds(
    df: DataFrame,
    columns: Sequence[str] = METRICS,
    threshold: float = IQR_THRESHOLD,
    relative_error: float | None = None,
) -> DataFrame:
    """One row per metric: quartiles and the bounds derived from them."""
    cuts = quartiles(df, columns, relative_error)
    rows = df.sparkSession.createDataFrame(
        [(c, *cuts[c]) for c in columns], "metric string, q1 double, q3 double"
    )
    reach = (F.col("q3") - F.col("q1")) * threshold
    return rows.select(
        "metric",
        F.round("q1", _DECIMALS).alias("q1"),
        F.round("q3", _DECIMALS).alias("q3"),
        F.round(F.col("q1") - reach, _DECIMALS).alias("lower_bound"),
        F.round(F.col("q3") + reach, _DECIMALS).alias("upper_bound"),
    )


def flag_iqr(
    df: DataFrame,
    columns: Sequence[str] = METRICS,
    threshold: float = IQR_THRESHOLD,
    relative_error: float | None = None,
) -> DataFrame:
    """Add ``<metric>_outlier``; with the bounds known, flagging is a map over the rows."""
    cuts = quartiles(df, columns, relative_error)
    flags = {}
    for c in columns:
        q1, q3 = (F.lit(q).cast("double") for q in cuts[c])
        flags[f"{c}_outlier"] = _flag(_outside(F.col(c), q1, q3, threshold))
    return df.withColumns(flags)


def flag_zscore(df: DataFrame, limits: Mapping[str, float] = Z_LIMITS) -> DataFrame:
    """Add ``<metric>_outlier`` for values further than the limit from the mean.

    Means and deviations come from one aggregate used as a scalar subquery.
    """
    moments = df.agg(
        F.struct(
            *[
                F.struct(
                    F.avg(known(c)).alias("mean"), F.stddev_pop(known(c)).alias("deviation")
                ).alias(c)
                for c in limits
            ]
        ).alias("moments")
    )
    scored = df.withColumn("_moments", moments.scalar())
    flags = {}
    for c, limit in limits.items():
        mean, deviation = F.col(f"_moments.{c}.mean"), F.col(f"_moments.{c}.deviation")
        z = F.abs(known(c) - mean) / F.nullif(deviation, F.lit(0.0))
        flags[f"{c}_outlier"] = _flag(F.round(z, _DECIMALS) > limit)
    return scored.withColumns(flags).drop("_moments")


def flag_rolling(
    df: DataFrame,
    columns: Sequence[str] = METRICS,
    rows: int = ROLLING_ROWS,
    threshold: float = IQR_THRESHOLD,
    order: Sequence[str] = ("event_ts", "collected_ts"),
    key: str = KEY,
    split_bits: int = SPLIT_BITS,
) -> DataFrame:
    """Interquartile flags against the device's last ``rows`` readings.

    One ordered frame per metric moves over the rows; see ``rolling_quantiles`` for its cost.
    Rows without a key or event time are in no such frame and are ``NORMAL``.
    """
    ordered = in_order(df, order, key, split_bits)
    complete = with_halo(ordered, rows - 1, columns, split_bits)
    framed = complete.withColumns({f"_k_{c}": F.col(c).cast("double") for c in columns})
    framed = rolling_quantiles(framed, [f"_k_{c}" for c in columns], rows, QUARTILES).filter(~F.col(HALO))
    placed = F.col(CHAIN).isNotNull()
    flags = {}
    for c in columns:
        q1, q3 = (F.col(f"__k_{c}_{k}") for k in range(len(QUARTILES)))
        flags[f"{c}_outlier"] = _flag(placed & _outside(F.col(c), q1, q3, threshold))
    return framed.withColumns(flags).select(*df.columns, *flags)
