"""Every registered query: name to a function of session and table folder."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge.functions import messages as msg
from fleetgauge.functions import timeparts as times
from fleetgauge.functions.timeparts import hours_touched, with_calendar, with_hour_key
from fleetgauge.operators import (
    cleansing,
    coverage,
    dashboard,
    gapfill,
    gate,
    latest,
    metrics,
    outages,
    outliers,
    partitions,
    rollup,
    routing,
    rulebook,
    scrape,
)
from fleetgauge.plans.readings import UNIQUE, messages, readings, timed_readings, uneven_messages
from fleetgauge.plans.shape import SECONDS, rounded, rows, shown, text
from fleetgauge.plans.streams import STREAMS
from fleetgauge.rules import FLEET_RANGES, INGEST_RANGES, ROUTES, TYPE_RULES, Range
from fleetgauge.schema import KEY, METRICS
from fleetgauge.sinks.catalogue import partition_changes
from fleetgauge.sources import files

Query = Callable[[SparkSession, str], DataFrame]

SHORT = ("event_id", KEY, "collected_at")
ORDER = ("event_ts", "collected_ts", *UNIQUE)
SLICE_AS_OF = datetime(2024, 1, 15, 12, 30)
_REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    _REGISTRY[function.__name__] = function
    return function


def newest_collection(df: DataFrame) -> Column:
    """The table's own "now": its newest collection time."""
    return df.agg(F.max("collected_ts")).scalar()


# Messages and derived columns


@query
def to_message(spark, sf_dir):
    return msg.to_messages(readings(spark, sf_dir), keep=UNIQUE)


@query
def parse_json(spark, sf_dir):
    parsed = msg.parse_messages(messages(spark, sf_dir), keep=UNIQUE)
    return rows(msg.well_formed(parsed))


@query
def malformed_json(spark, sf_dir):
    return msg.malformed(msg.parse_messages(messages(spark, sf_dir), keep=UNIQUE), keep=UNIQUE)


@query
def derive_time(spark, sf_dir):
    df = with_calendar(with_hour_key(timed_readings(spark, sf_dir)))
    return df.select(
        *SHORT,
        shown("event_ts"),
        shown("collected_ts"),
        "ymdh",
        *text("year", "month", "day", "hour"),
    )


@query
def path_key(spark, sf_dir):
    df = timed_readings(spark, sf_dir).filter("event_ts is not null")
    return df.select(*SHORT, times.path_key(F.col("event_ts"), F.col(KEY)).alias("path_key"))


@query
def cast_motors(spark, sf_dir):
    return cleansing.cast_motors(readings(spark, sf_dir)).select(*SHORT, "motor1", "motor2", "motor3")


# Routing


@query
def valid_range_flag(spark, sf_dir):
    return routing.flag_valid(readings(spark, sf_dir)).select(*SHORT, *text("valid"))


CHANGES = ("2024-01-10 00:00:00", "2024-01-20 12:00:00")


@query
def valid_range_as_of(spark, sf_dir):
    """Readings by the rules of their time: the fleet's ranges, then the gate's, then the cleansing stream's."""
    first, second = CHANGES
    typed = [Range(r.column, r.low, r.high) for r in TYPE_RULES if r.low is not None]
    rules = rulebook.rule_table(spark, FLEET_RANGES, valid_to=first)
    rules = rules.unionByName(rulebook.rule_table(spark, INGEST_RANGES, first, second))
    rules = rules.unionByName(rulebook.rule_table(spark, typed, second))
    judged = rulebook.judge_as_of(timed_readings(spark, sf_dir), rules, [r.column for r in FLEET_RANGES])
    return judged.select(*SHORT, *text("valid"))


def _route(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rows(routing.take_route(readings(spark, sf_dir), name))

    return run


_REGISTRY.update({f"route_{name}": _route(name) for name in ROUTES})


@query
def route_counts(spark, sf_dir):
    return routing.route_counts(readings(spark, sf_dir))


# Cleansing


@query
def reject_null_keys(spark, sf_dir):
    return rows(cleansing.require_keys(readings(spark, sf_dir)))


@query
def alerts(spark, sf_dir):
    return rows(cleansing.alerts(readings(spark, sf_dir)))


@query
def ingest_gate(spark, sf_dir):
    return rows(cleansing.ingest_gate(readings(spark, sf_dir)))


@query
def ingest_gate_messages(spark, sf_dir):
    """Raw messages at the gate, with every failed check; absent and null are different."""
    judged = gate.judge_messages(uneven_messages(spark, sf_dir), keep=UNIQUE)
    return gate.gate_report(judged, UNIQUE).withColumn("passes", F.col("passes").cast("string"))


@query
def validate_types(spark, sf_dir):
    valid = cleansing.validate_types(readings(spark, sf_dir))
    return rows(valid).withColumn(KEY, F.col(KEY).cast("string"))


@query
def handle_nulls(spark, sf_dir):
    return rows(cleansing.handle_nulls(readings(spark, sf_dir)))


def _cleansed(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = cleansing.require_keys(readings(spark, sf_dir))
    return cleansing.cleanse(cleansing.cast_motors(keyed))


@query
def cleanse(spark, sf_dir):
    return rows(_cleansed(spark, sf_dir))


# Latest, recency, deduplication


def _latest(route: str | None) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = timed_readings(spark, sf_dir)
        if route is not None:
            df = routing.take_route(df, route)
        return latest.latest_per_device(df, UNIQUE).select(KEY, "event_id", "time", *METRICS)

    return run


_REGISTRY.update({f"latest_{name or 'raw'}": _latest(name) for name in (None, *ROUTES)})


@query
def latest_count(spark, sf_dir):
    """Devices per gauge family."""
    winners = latest.latest_per_route(timed_readings(spark, sf_dir).withColumn("recent", F.lit(True)), UNIQUE)
    return metrics.families(winners, UNIQUE).groupBy("family").agg(F.count("*").alias("devices"))


@query
def recent_readings(spark, sf_dir):
    df = timed_readings(spark, sf_dir)
    return latest.recent(df, newest_collection(df)).select(*SHORT)


@query
def dedup_readings(spark, sf_dir):
    return rows(latest.dedup_readings(timed_readings(spark, sf_dir), tiebreak=UNIQUE))


@query
def hour_slice(spark, sf_dir):
    df = routing.with_route(with_hour_key(timed_readings(spark, sf_dir)))
    return files.hour_slice(df, hours_touched(SLICE_AS_OF)).select(*SHORT, "route", "ymdh")


# Rollups and coverage


def _data_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_hour_key(routing.take_route(timed_readings(spark, sf_dir), "data"))


@query
def hourly_device_mean(spark, sf_dir):
    means = rollup.hourly_device_mean(_data_by_hour(spark, sf_dir))
    return means.select(KEY, "ymdh", *rounded(*[f"{c}_avg" for c in METRICS]))


@query
def hourly_device_report(spark, sf_dir):
    means = rollup.hourly_device_mean(_data_by_hour(spark, sf_dir))
    return rollup.hourly_device_report(means).withColumnRenamed("value", "report")


@query
def device_batch_stats(spark, sf_dir):
    stats = rollup.device_batch_stats(readings(spark, sf_dir))
    return stats.select(KEY, shown("latest_time"), *rounded(*METRICS, "fail_rate"))


@query
def cleansed_batch_gauges(spark, sf_dir):
    """The rules stream end to end: gate, cast, cleanse, per-device gauges."""
    gauges = metrics.batch_gauges(rollup.device_batch_stats(_cleansed(spark, sf_dir)))
    return gauges.select("metric", "device_id", *rounded("value"))


@query
def data_quality_score(spark, sf_dir):
    scores = rollup.data_quality_score(readings(spark, sf_dir))
    return scores.select(KEY, "readings", *rounded("quality_score"))


@query
def device_coverage(spark, sf_dir):
    return coverage.device_coverage(readings(spark, sf_dir))


@query
def missing_devices(spark, sf_dir):
    df = with_hour_key(timed_readings(spark, sf_dir))
    return coverage.missing_devices(files.hour_slice(df, hours_touched(SLICE_AS_OF)))


@query
def device_online(spark, sf_dir):
    df = timed_readings(spark, sf_dir)
    online = coverage.device_online(df, newest_collection(df))
    return online.select(KEY, shown("last_seen"), "online")


@query
def device_outages(spark, sf_dir):
    """Online spans of every device, a silence of six hours apart, and the silence before each."""
    spans = outages.online_spans(timed_readings(spark, sf_dir), 6 * 60, ORDER)
    return spans.select(KEY, "span", shown("online_from"), shown("online_to"), "readings", *text("silent_seconds"))


@query
def distinct_partitions(spark, sf_dir):
    timed = timed_readings(spark, sf_dir).filter("event_ts is not null")
    return partitions.distinct_partitions(with_calendar(timed))


@query
def partition_inventory(spark, sf_dir):
    """Inventory of the folders the readings would be filed under."""
    df = with_hour_key(timed_readings(spark, sf_dir))
    folder = F.format_string("table/DeviceId=%d/ymdh=%s/part.parquet", KEY, "ymdh")
    return partitions.partition_inventory(df.select(folder.alias("path")))


@query
def partition_reconcile(spark, sf_dir):
    """What to add and to drop where the catalogue knows the first two thirds of the hours, and one that is gone."""
    df = with_hour_key(timed_readings(spark, sf_dir))
    named = F.format_string("DeviceId=%d/ymdh=%s", KEY, "ymdh").alias("partition")
    registered = df.filter("ymdh < '2024012000'").select(named)
    listed = df.filter("ymdh >= '2024010200'").select(named)
    return partition_changes(listed, registered)


# Outliers and gaps


@query
def outlier_bounds(spark, sf_dir):
    return outliers.outlier_bounds(readings(spark, sf_dir))


def _flags(df: DataFrame) -> DataFrame:
    return df.select(*SHORT, *[f"{c}_outlier" for c in METRICS])


@query
def outlier_iqr(spark, sf_dir):
    return _flags(outliers.flag_iqr(readings(spark, sf_dir)))


@query
def outlier_zscore(spark, sf_dir):
    return _flags(outliers.flag_zscore(readings(spark, sf_dir)))


@query
def outlier_rolling(spark, sf_dir):
    return _flags(outliers.flag_rolling(timed_readings(spark, sf_dir), order=ORDER))


@query
def fill_previous(spark, sf_dir):
    return rows(gapfill.fill_previous(timed_readings(spark, sf_dir), order=ORDER))


@query
def fill_previous_one_step(spark, sf_dir):
    filled = gapfill.fill_previous(timed_readings(spark, sf_dir), order=ORDER, max_gap=1)
    return rows(filled)


# Gauges and panels


@query
def metric_snapshot(spark, sf_dir):
    return metrics.metric_snapshot(timed_readings(spark, sf_dir), UNIQUE)


@query
def metric_snapshot_recent(spark, sf_dir):
    df = timed_readings(spark, sf_dir)
    return metrics.metric_snapshot(df, UNIQUE, as_of=newest_collection(df))


@query
def panel_series(spark, sf_dir):
    df = timed_readings(spark, sf_dir)
    until = df.agg(F.max("event_ts")).scalar()
    points = dashboard.panel_series(df, until, pattern="[1-9][0-9]?", minutes=24 * 60)
    return points.select(KEY, shown("event_ts"), "metric", "value")


@query
def panel_series_1m(spark, sf_dir):
    points = dashboard.panel_series_sampled(timed_readings(spark, sf_dir), tiebreak=UNIQUE)
    return points.select(KEY, shown("sampled_at", SECONDS), "metric", "value")


@query
def panel_scraped(spark, sf_dir):
    """Samples at every full minute until the reading behind them is stale."""
    points = scrape.scraped_series(timed_readings(spark, sf_dir), order=ORDER)
    return points.select(KEY, shown("sampled_at", SECONDS), "metric", "value")


@query
def panel_legend(spark, sf_dir):
    return dashboard.panel_legend(timed_readings(spark, sf_dir), UNIQUE)


@query
def threshold_state(spark, sf_dir):
    points = metrics.to_long(readings(spark, sf_dir), SHORT)
    return dashboard.threshold_state(points)


@query
def device_labels(spark, sf_dir):
    return dashboard.device_labels(readings(spark, sf_dir))


def registered() -> dict[str, Query]:
    return {**_REGISTRY, **{stream.__name__: stream for stream in STREAMS}}
