"""Streaming jobs run to the end of the test table, then read back from their sinks.

Each run has a folder of its own in the shared folder the cluster names.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetgauge.functions.messages import parse_messages, to_messages, well_formed
from fleetgauge.functions.timeparts import with_hour_key, with_times
from fleetgauge.operators.latest import latest_per_device
from fleetgauge.operators.metrics import to_long
from fleetgauge.operators.partials import partial_means
from fleetgauge.operators.routing import take_route
from fleetgauge.operators.sketches import QUARTILES, RANK_ERROR, sketched_bounds
from fleetgauge.plans.readings import UNIQUE, derive_readings, events
from fleetgauge.plans.shape import rounded, rows, shown, text
from fleetgauge.schema import KEY, METRICS, READING_COLUMNS
from fleetgauge.session import scratch_path
from fleetgauge.sources.files import text_stream
from fleetgauge.streaming import queries as run
from fleetgauge.streaming.online import online_edges
from fleetgauge.streaming.seen import seen_batch, stored_rows
from fleetgauge.streaming.transforms import hourly_mean_stream, latest_stream, route_stream

ROUTED = ("event_id", "route", KEY, "time", *METRICS)
SENT = [c for c in READING_COLUMNS if c != "isFail"]


def readings_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A glob, because a stream takes a folder or a pattern but not one file's path."""
    schema = events(spark, sf_dir).schema
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir}/events*.parquet")
    return derive_readings(stream)


def stream_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deduplicated and routed, into one partitioned table with exactly-once files."""
    base = scratch_path(spark, "stream-routes")
    routed = route_stream(readings_stream(spark, sf_dir))
    run.route_to_files(
        routed, f"{base}/table", f"{base}/checkpoint", layout=("route",), every=None
    ).awaitTermination()
    return spark.read.parquet(f"{base}/table").select(*ROUTED, *text("isFail"))


def stream_route_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows through the replayable batch callback."""
    base = scratch_path(spark, "stream-batches")
    routed = route_stream(readings_stream(spark, sf_dir))
    run.route_in_batches(
        routed, f"{base}/staging", f"{base}/checkpoint", layout=("route",), every=None
    ).awaitTermination()
    return spark.read.parquet(f"{base}/staging").select(*ROUTED, *text("isFail"))


def stream_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running latest per device; the newest state of each device is its answer."""
    base = scratch_path(spark, "stream-latest")
    running = latest_stream(with_times(readings_stream(spark, sf_dir)), *UNIQUE)
    store = run.replace_batch(f"{base}/changes")
    run.for_batches(running, store, f"{base}/checkpoint", "update", every=None).awaitTermination()
    changes = spark.read.parquet(f"{base}/changes")
    return latest_per_device(changes, UNIQUE).select(KEY, "event_id", "time", *METRICS)


def stream_hourly_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly means of the hours the watermark has closed."""
    base = scratch_path(spark, "stream-hours")
    means = hourly_mean_stream(with_times(readings_stream(spark, sf_dir)))
    run.to_files(means, f"{base}/table", f"{base}/checkpoint", every=None).awaitTermination()
    return spark.read.parquet(f"{base}/table").select(
        KEY, "ymdh", *rounded(*[f"{c}_avg" for c in METRICS])
    )


def stream_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleansing stream: raw archive, alerts, cleansed table and gauges."""
    base = scratch_path(spark, "stream-rules")
    readings = readings_stream(spark, sf_dir)
    run.run_rules(
        readings, f"{base}/out", f"{base}/checkpoint", ("year", "month", "day"), every=None
    ).awaitTermination()
    gauges = run.current_gauges(spark.read.parquet(f"{base}/out/gauges"))
    return gauges.select("metric", "device_id", *rounded("value"))


def stream_fill_previous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gaps filled batch by batch from what each device last knew."""
    base = scratch_path(spark, "stream-fill")
    timed = with_times(readings_stream(spark, sf_dir))
    store = run.fill_batch(base, order=("event_ts", "collected_ts", *UNIQUE))
    run.for_batches(timed, store, f"{base}/checkpoint", every=None).awaitTermination()
    return rows(spark.read.parquet(f"{base}/filled"))


def stream_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages landed as lines by one stream, picked up and parsed by a second."""
    base = scratch_path(spark, "stream-landing")
    sent = to_messages(readings_stream(spark, sf_dir))
    run.land_lines(sent, f"{base}/landed", f"{base}/landing", every=None).awaitTermination()
    lines = text_stream(spark, f"{base}/landed")
    parsed = well_formed(parse_messages(lines))
    run.to_files(parsed, f"{base}/parsed", f"{base}/parsing", every=None).awaitTermination()
    return spark.read.parquet(f"{base}/parsed").select(*SENT, *text("isFail"))


def arrivals(spark: SparkSession, sf_dir: str, rounds: Sequence[str], run_round: Callable[[DataFrame], StreamingQuery]) -> None:
    """The readings in rounds: each lands its part and runs the stream to the end of what is there.

    Every round goes on from the checkpoint of the one before, as a restarted stream does.
    """
    landed = scratch_path(spark, "arrivals")
    rows = derive_readings(events(spark, sf_dir))
    for chosen in rounds:
        rows.filter(chosen).write.mode("append").parquet(landed)
        run_round(spark.readStream.schema(rows.schema).parquet(landed)).awaitTermination()


# Parts that hold readings of every hour: all but the first arrive after their hour's first are counted.
SCATTERED = tuple(f"event_id % 3 = {k}" for k in (2, 0, 1))


def stream_hourly_mean_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly means over several micro-batches, each of which adds late readings to hours already stored."""
    base = scratch_path(spark, "stream-late-hours")
    store = run.late_hours(f"{base}/partials")

    def once(readings: DataFrame) -> StreamingQuery:
        rows = with_hour_key(take_route(with_times(readings), "data"))
        return run.for_batches(rows, store.store, f"{base}/checkpoint", every=None)

    arrivals(spark, sf_dir, SCATTERED, once)
    means = partial_means(store.states(spark))
    return means.select(KEY, "ymdh", *rounded(*[f"{c}_avg" for c in METRICS]))


def stream_outlier_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quartiles from sketches stored by several micro-batches, and whether their ranks are near enough."""
    base = scratch_path(spark, "stream-sketches")
    store = run.hour_sketch_store(f"{base}/sketches")

    def once(readings: DataFrame) -> StreamingQuery:
        rows = with_hour_key(with_times(readings))
        return run.for_batches(rows, store.store, f"{base}/checkpoint", every=None)

    arrivals(spark, sf_dir, SCATTERED, once)
    bounds = sketched_bounds(store.states(spark))
    cuts = to_long(derive_readings(events(spark, sf_dir)), ()).join(F.broadcast(bounds.select("metric", "q1", "q3")), "metric")
    shares = [F.avg((F.col("value") < F.col(q)).cast("int")).alias(f"{q}_less") for q in ("q1", "q3")]
    shares += [F.avg((F.col("value") <= F.col(q)).cast("int")).alias(f"{q}_most") for q in ("q1", "q3")]
    near = {
        f"{q}_near": ((F.col(f"{q}_less") <= p + RANK_ERROR) & (F.col(f"{q}_most") >= p - RANK_ERROR)).cast("string")
        for q, p in zip(("q1", "q3"), QUARTILES)
    }
    found = bounds.join(cuts.groupBy("metric").agg(*shares).withColumns(near), "metric")
    return found.select("metric", "readings", *rounded("lowest", "highest"), *near)


def stream_dedup_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deduplicated over any distance: a reading's copies arrive in other micro-batches, before or after it."""
    base = scratch_path(spark, "stream-seen")
    store = seen_batch(base, UNIQUE)

    def once(readings: DataFrame) -> StreamingQuery:
        return run.for_batches(with_times(readings), store, f"{base}/checkpoint", every=None)

    arrivals(spark, sf_dir, tuple(f"pmod(hash(collected_at), 3) = {k}" for k in range(3)), once)
    return stored_rows(spark, base).select("event_id", KEY, "time", *METRICS, *text("isFail"))


def stream_online_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When each device went on- and offline, from timers; the readings come in three parts, by time."""
    base = scratch_path(spark, "stream-edges")
    name, store = "spark.sql.streaming.stateStore.providerClass", run.ROCKSDB
    before = spark.conf.get(name)
    spark.conf.set(name, store)

    def once(readings: DataFrame) -> StreamingQuery:
        edges = online_edges(with_times(readings), quiet_minutes=6 * 60, forget_minutes=48 * 60)
        return run.to_files(edges, f"{base}/edges", f"{base}/checkpoint", every=None)

    parts = ("time < '2024-01-10'", "time >= '2024-01-10' and time < '2024-01-20'", "time >= '2024-01-20'")
    try:
        arrivals(spark, sf_dir, parts, once)
    finally:
        spark.conf.set(name, before)
    return spark.read.parquet(f"{base}/edges").select(KEY, shown("changed_at"), "online")


STREAMS = (
    stream_routes,
    stream_route_batches,
    stream_latest,
    stream_hourly_mean,
    stream_hourly_mean_corrected,
    stream_outlier_sketches,
    stream_dedup_exact,
    stream_online_edges,
    stream_rules,
    stream_fill_previous,
    stream_landing,
)
