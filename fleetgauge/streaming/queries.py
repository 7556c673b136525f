"""Start streaming queries. Every one names its own checkpoint.

The file sinks commit through their own log and are exactly-once. The batch callbacks
write each micro-batch to a folder named after its id and replace that folder, so a
batch that is run again after a failure leaves the same result.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from fleetgauge.functions.timeparts import parse_time, with_calendar
from fleetgauge.operators.cleansing import alerts, cast_motors, cleanse, require_keys
from fleetgauge.operators.gapfill import fill_previous
from fleetgauge.operators.metrics import batch_gauges
from fleetgauge.operators.partials import PARTIALS, hour_partials, merge_partials
from fleetgauge.operators.rollup import device_batch_stats
from fleetgauge.operators.sketches import SKETCHES, hour_sketches, merge_sketches
from fleetgauge.schema import KEY, METRICS
from fleetgauge.session import scratch_scope
from fleetgauge.sinks.tables import LAYOUT, RAW_LAYOUT, STAGING_LAYOUT, packed
from fleetgauge.streaming.stores import MergeStore

# State of timers and of large deduplication windows is kept off the heap.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Trigger intervals per sink.
TRIGGERS = {
    "landing": "30 seconds",
    "routed": "30 seconds",
    "raw": "30 seconds",
    "cleansed": "1 minute",
    "alerts": "10 seconds",
}


def _triggered(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    """``every=None`` runs over what is there and stops."""
    if every is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=every)


def to_files(
    df: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    layout: Sequence[str] = (),
    every: str | None = TRIGGERS["routed"],
    **options: str,
) -> StreamingQuery:
    """Append to a folder of files, exactly once."""
    writer = df.writeStream.format(fmt).outputMode("append").option("path", path)
    writer = writer.option("checkpointLocation", checkpoint).options(**options)
    if layout:
        writer = writer.partitionBy(*layout)
    return _triggered(writer, every).start()


def land_messages(
    bus: DataFrame,
    path: str,
    checkpoint: str,
    envelope: str = "value",
    every: str | None = TRIGGERS["landing"],
) -> StreamingQuery:
    """Archive each payload unparsed as JSON lines, one ``json`` field per message."""
    text = bus.select(bus[envelope].cast("string").alias("json"))
    return to_files(text, path, checkpoint, "json", every=every)


def land_lines(
    bus: DataFrame,
    path: str,
    checkpoint: str,
    envelope: str = "value",
    every: str | None = TRIGGERS["landing"],
) -> StreamingQuery:
    """Land payloads one per line, ready for the JSON file stream.

    A line break inside a payload, which JSON allows between its parts only, becomes a blank.

    Progress is in the checkpoint, so a failed write is retried and loses nothing.
    """
    return to_files(
        bus.select(F.regexp_replace(bus[envelope].cast("string"), r"[\r\n]+", " ").alias("value")),
        path,
        checkpoint,
        "text",
        every=every,
    )


def route_to_files(
    routed: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    layout: Sequence[str] = LAYOUT,
    every: str | None = TRIGGERS["routed"],
) -> StreamingQuery:
    """All routes in one query: the source is read once, not once per route."""
    return to_files(routed, path, checkpoint, fmt, layout, every, compression="snappy")


def replace_batch(
    path: str, layout: Sequence[str] = (), fmt: str = "parquet", compression: str = "snappy"
) -> Callable[[DataFrame, int], None]:
    """A callback that stores each micro-batch under ``batch_id=N``."""

    def store(batch: DataFrame, batch_id: int) -> None:
        rows = packed(batch, layout) if layout else batch
        writer = rows.write.mode("overwrite").format(fmt)
        if fmt == "parquet":
            writer = writer.option("compression", compression)
        if layout:
            writer = writer.partitionBy(*layout)
        writer.save(f"{path}/batch_id={batch_id}")

    return store


def for_batches(
    df: DataFrame,
    store: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    every: str | None = TRIGGERS["routed"],
) -> StreamingQuery:
    writer = df.writeStream.foreachBatch(store).outputMode(mode)
    return _triggered(writer.option("checkpointLocation", checkpoint), every).start()


def route_in_batches(
    routed: DataFrame,
    path: str,
    checkpoint: str,
    layout: Sequence[str] = STAGING_LAYOUT,
    every: str | None = TRIGGERS["routed"],
) -> StreamingQuery:
    """Routed rows to a staging table, packed per partition; see ``compact_hours``."""
    return for_batches(routed, replace_batch(path, layout), checkpoint, every=every)


def rules_batch(
    base: str, raw_layout: Sequence[str] = RAW_LAYOUT
) -> Callable[[DataFrame, int], None]:
    """The cleansing stream's outputs for one micro-batch of parsed readings.

    Raw archive, alerts, cleansed rows and gauges all come from one read of the batch,
    and each goes to its own folder per batch.
    """
    raw = replace_batch(f"{base}/raw", raw_layout, compression="gzip")
    lost = replace_batch(f"{base}/alerts", fmt="json")
    clean = replace_batch(f"{base}/cleansed", (KEY,))
    gauges = replace_batch(f"{base}/gauges")

    def store(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            keyed = cast_motors(require_keys(batch))
            dated = with_calendar(keyed.withColumn("event_ts", parse_time("time")))
            raw(dated.drop("event_ts", "hour"), batch_id)
            lost(alerts(batch), batch_id)
            cleansed = cleanse(keyed)
            clean(cleansed, batch_id)
            gauges(batch_gauges(device_batch_stats(cleansed)), batch_id)
        finally:
            batch.unpersist()

    return store


def current_gauges(batches: DataFrame) -> DataFrame:
    """Each gauge's value from the newest batch that set it."""
    return batches.groupBy("metric", "device_id").agg(F.max_by("value", "batch_id").alias("value"))


def run_rules(
    readings: DataFrame,
    base: str,
    checkpoint: str,
    raw_layout: Sequence[str] = RAW_LAYOUT,
    every: str | None = TRIGGERS["raw"],
) -> StreamingQuery:
    return for_batches(readings, rules_batch(base, raw_layout), checkpoint, every=every)


def fill_batch(
    base: str, columns: Sequence[str] = METRICS, order: Sequence[str] = ("event_ts", "collected_ts")
) -> Callable[[DataFrame, int], None]:
    """Previous-value fill on a stream.

    Inside a batch, readings are filled in event-time order. The last known value of each
    metric is stored per batch with the time it is of, a row for each device and metric,
    and takes part in the next batch at that time. A gap is filled from the batch before,
    and a late reading does not replace what is newer. A replayed batch starts from the
    same stored values.
    """
    rows, values = replace_batch(f"{base}/filled"), replace_batch(f"{base}/known")

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        schema = T.StructType([f for f in batch.schema if f.name in (KEY, *order, *columns)])
        known = spark.createDataFrame([], schema)
        if batch_id > 0:
            known = spark.read.schema(schema).parquet(f"{base}/known/batch_id={batch_id - 1}")
        batch = batch.persist()
        try:
            lead = known.withColumn("_lead", F.lit(True))
            both = batch.withColumn("_lead", F.lit(False)).unionByName(lead, allowMissingColumns=True)
            with scratch_scope(spark):
                filled = fill_previous(both, columns, order)
                rows(filled.filter(~F.col("_lead")).select(*batch.columns), batch_id)
            placed = F.col(KEY).isNotNull() & F.col(order[0]).isNotNull()
            told = batch.filter(placed).select(*schema.names).unionByName(known.select(*schema.names))
            values(newest_known(told, columns, order).select(*schema.names), batch_id)
        finally:
            batch.unpersist()

    return store


def newest_known(readings: DataFrame, columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    """A row for each device and metric with its newest value, the time it is of, and no other metric."""
    newest = [
        F.max_by(F.struct(*order, c), F.when(F.col(c).isNotNull(), F.struct(*order))).alias(c) for c in columns
    ]
    wide = readings.groupBy(KEY).agg(*newest)
    each = [
        F.struct(
            *[F.col(f"{c}.{o}").alias(o) for o in order],
            *[(F.col(f"{c}.{c}") if c == other else F.lit(None).cast("double")).alias(other) for other in columns],
        )
        for c in columns
    ]
    long = wide.select(KEY, F.explode(F.array(*each)).alias("one")).select(KEY, "one.*")
    return long.filter(F.coalesce(*columns).isNotNull())


def await_all(queries: Sequence[StreamingQuery]) -> None:
    """Return when all queries have ended; as soon as one fails, stop the others and raise its error.

    Waiting for one after the other would hide a failure of a later one for as long as an
    earlier one runs. A wait of a second on one that has failed raises.
    """
    try:
        while not all([query.awaitTermination(1) for query in queries]):
            pass
    finally:
        for query in queries:
            if query.isActive:
                query.stop()


def late_hours(base: str) -> MergeStore:
    """Sums and counts per device and hour; ``partial_means`` of its states are the hourly means so far."""
    return MergeStore(base, PARTIALS, hour_partials, merge_partials)


def hour_sketch_store(base: str) -> MergeStore:
    """Quantile sketches per device and hour; ``sketched_bounds`` of its states are the outlier bounds."""
    return MergeStore(base, SKETCHES, hour_sketches, merge_sketches)
