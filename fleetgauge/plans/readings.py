"""Readings derived from the ``events`` test table.

The derivation yields valid and out-of-range rows, missing values, bad times, device
numbers outside the fleet, and readings that arrive a second time a minute later.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge.functions.messages import to_messages
from fleetgauge.functions.timeparts import with_times
from fleetgauge.schema import READING_COLUMNS
from fleetgauge.session import use_utc

ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
UNIQUE = ("event_id",)
MESSAGE_CUT = 20


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/events.parquet")


def derive_readings(events: DataFrame) -> DataFrame:
    """Works on the table and on a stream of it alike."""
    n, ts = F.col("event_id"), F.col("ts")
    null = F.lit(None)
    copies = F.when(n % 20 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = events.withColumn("copy", F.explode(copies))
    late = F.make_dt_interval(secs=(n % 7 + 60 * F.col("copy")).cast("decimal(18,6)"))
    columns = {
        "time": F.when(n % 199 == 11, "not-a-time")
        .when(n % 199 == 12, null)
        .otherwise(F.date_format(ts, ISO)),
        "DeviceId": (F.col("user_id") % 103 + 1).cast("int"),
        "sensor1": F.when(n % 97 == 5, null).otherwise(F.col("value")),
        "sensor2": F.when(n % 89 == 7, null).otherwise((n * 37 % 1050).cast("double") / 10.0),
        "sensor3": F.regexp_extract("props", "([0-9]+)", 1).cast("double") * 1.55,
        "motor1": (n * 7919 % 2050).cast("double"),
        "motor2": (n * 104729 % 1530).cast("double"),
        "motor3": (n * 1299709 % 1830).cast("double"),
        "isFail": F.when(n % 211 == 3, null).otherwise(F.col("event_type") == "error"),
        "collected_at": F.date_format(ts + late, ISO),
    }
    return rows.select(n, *[columns[c].alias(c) for c in READING_COLUMNS])


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive_readings(events(spark, sf_dir))


def timed_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With ``event_ts`` and ``collected_ts``; unused ones are pruned from the plan."""
    return with_times(readings(spark, sf_dir))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings as bus messages, some of them cut off in the middle."""
    sent = to_messages(readings(spark, sf_dir), keep=UNIQUE)
    cut = F.when(F.col("event_id") % 97 == 0, F.substring("value", 1, MESSAGE_CUT))
    return sent.withColumn("value", F.coalesce(cut, "value").cast("binary"))


def uneven_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages some of which lack a field, hold a null or the wrong type, or are cut off."""
    sent = to_messages(readings(spark, sf_dir), keep=UNIQUE)
    n, value = F.col("event_id"), F.col("value")
    # One column after the other: nested, each step would double the expression.
    for chosen, pattern, instead in (
        (n % 61 == 2, '"motor2":[^,]*', '"motor2":null'),
        (n % 67 == 3, '"motor1":[^,]*,', ""),
        (n % 71 == 5, '"sensor3":[^,]*', '"sensor3":"hot"'),
        (n % 73 == 7, '"isFail":[^,]*,', ""),
        (n % 79 == 11, '"DeviceId":([0-9]+)', '"DeviceId":"$1"'),
    ):
        sent = sent.withColumn("value", F.when(chosen, F.regexp_replace(value, pattern, instead)).otherwise(value))
    value = F.when(n % 97 == 0, F.substring(value, 1, MESSAGE_CUT)).otherwise(value)
    return sent.withColumn("value", value.cast("binary"))
