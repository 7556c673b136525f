"""Gauges as a metrics server sees them that asks every minute.

Between two readings a device's gauges keep the values of the earlier one, until they are
stale. A sample is taken at every full minute at which a reading stands, whether or not
one came in that minute.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgauge.operators.metrics import to_long
from fleetgauge.operators.ordered import SPLIT_BITS, carried, in_order
from fleetgauge.rules import SCRAPE_MINUTES, STALE_MINUTES
from fleetgauge.schema import KEY, METRICS

MINUTE = 60_000_000


def scraped_series(
    df: DataFrame,
    stale_minutes: int = STALE_MINUTES,
    every_minutes: int = SCRAPE_MINUTES,
    order: Sequence[str] = ("event_ts", "collected_ts"),
    columns: Sequence[str] = METRICS,
    key: str = KEY,
    split_bits: int = SPLIT_BITS,
) -> DataFrame:
    """``key``, ``sampled_at``, ``metric``, ``value``: the newest reading not after each grid time.

    A reading stands from its time until the next one's, exclusive, and for less than
    ``stale_minutes``. The next reading's time is carried over the ordered splits, so that
    a device's grid is made by as many tasks as its readings are in; a reading makes at
    most ``stale_minutes`` grid times. Metrics that are NULL in it have no sample.
    """
    moment = order[0]
    placed = df.filter(F.col(key).isNotNull() & F.col(moment).isNotNull()).select(key, *order, *columns)
    ordered = in_order(placed, order, key, split_bits)
    rows = carried(ordered, {"_next": F.col(moment)}, "min", after=True)
    step = every_minutes * MINUTE
    begins, ends = F.unix_micros(moment), F.unix_micros(moment) + stale_minutes * MINUTE
    # Grid times of a half-open interval: from its start rounded up to its end rounded up, exclusive.
    first = F.ceil(begins / step)
    last = F.ceil(F.least(ends, F.coalesce(F.unix_micros("_next"), ends)) / step) - 1
    rows = rows.select(key, *columns, first.alias("_first"), last.alias("_last")).filter("_first <= _last")
    grid = rows.withColumn("_at", F.explode(F.sequence("_first", "_last")))
    sampled = grid.withColumn("sampled_at", F.timestamp_micros(F.col("_at") * step))
    return to_long(sampled, (key, "sampled_at"), columns)
