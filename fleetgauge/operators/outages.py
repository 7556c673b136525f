"""When a device was heard from without a break, and when it was silent.

A device is online from a reading until the last one that follows another within
``quiet_minutes``. A longer silence is an outage; it ends with the next reading.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgauge.operators.ordered import CHAIN, SPLIT_BITS, carried, in_order
from fleetgauge.rules import RETENTION_MINUTES
from fleetgauge.schema import KEY

RECENCY = ("event_ts", "collected_ts")


def online_spans(
    df: DataFrame,
    quiet_minutes: float = RETENTION_MINUTES,
    order: Sequence[str] = RECENCY,
    key: str = KEY,
    split_bits: int = SPLIT_BITS,
) -> DataFrame:
    """A row for each online span: ``key``, ``span`` from 1, ``online_from``, ``online_to``, ``readings``
    and ``silent_seconds``, the silence before it, NULL for a device's first.

    The previous reading's time and the number of breaks so far are carried over the
    ordered splits, and spans are counted up from partial counts, so no task holds a device.
    Rows without a device or time are in no span.
    """
    moment = order[0]
    placed = df.filter(F.col(key).isNotNull() & F.col(moment).isNotNull()).select(key, *order)
    ordered = in_order(placed, order, key, split_bits)
    before = carried(ordered, {"_before": F.col(moment)}, "max")
    # Whole microseconds: a difference of timestamps as seconds would round.
    silent = F.unix_micros(moment) - F.unix_micros("_before")
    opens = F.col("_before").isNull() | (silent > int(quiet_minutes * 60_000_000))
    marked = before.select(*ordered.columns, silent.alias("_silent"), opens.cast("int").alias("_opens"))
    spans = carried(marked, {"_earlier": F.col("_opens")}, "sum")
    number = (F.coalesce("_earlier", F.lit(0)) + F.col("_opens")).cast("long")
    return (
        spans.groupBy(F.col(CHAIN).alias(key), number.alias("span"))
        .agg(
            F.min(moment).alias("online_from"),
            F.max(moment).alias("online_to"),
            F.count("*").alias("readings"),
            (F.max(F.when(F.col("_opens") == 1, F.col("_silent"))) / 1_000_000).alias("silent_seconds"),
        )
    )


def outages(spans: DataFrame, key: str = KEY) -> DataFrame:
    """The silences between spans: ``key``, ``offline_from``, ``offline_to`` and ``seconds``."""
    micros = F.unix_micros("online_from") - (F.col("silent_seconds") * 1_000_000).cast("long")
    return spans.filter(F.col("silent_seconds").isNotNull()).select(
        key,
        F.timestamp_micros(micros).alias("offline_from"),
        F.col("online_from").alias("offline_to"),
        F.col("silent_seconds").alias("seconds"),
    )


def online_seconds(spans: DataFrame, key: str = KEY) -> DataFrame:
    """Per device: spans, readings, and seconds from its first to its last reading online and in all."""
    online = (F.unix_micros("online_to") - F.unix_micros("online_from")) / 1_000_000
    whole = (F.unix_micros(F.max("online_to")) - F.unix_micros(F.min("online_from"))) / 1_000_000
    return spans.groupBy(key).agg(
        F.count("*").alias("spans"),
        F.sum("readings").alias("readings"),
        F.sum(online).alias("online_seconds"),
        whole.alias("seconds"),
    )
