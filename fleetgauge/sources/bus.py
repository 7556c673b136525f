"""Message-bus streams. The connector jar is the deployment's business."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def bus_stream(
    spark: SparkSession,
    brokers: str,
    topic: str,
    starting_offsets: str | None = None,
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """Subscribe to one topic; the payload is the ``value`` column."""
    options = bus_options(brokers, topic, starting_offsets, max_offsets_per_trigger)
    return spark.readStream.format("kafka").options(**options).load()


def bus_options(
    brokers: str, topic: str, starting_offsets: str | None = None, max_offsets_per_trigger: int | None = None
) -> dict[str, str]:
    """What the connector is told; what is not given is left to it."""
    options = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "maxOffsetsPerTrigger": max_offsets_per_trigger,
    }
    return {name: str(value) for name, value in options.items() if value}


def shard_stream(
    spark: SparkSession,
    stream: str,
    region: str,
    provider: str,
    starting_position: str = "latest",
) -> DataFrame:
    """A sharded cloud stream through whichever connector the cluster installs.

    Open Spark ships none, so the format name is an argument. The payload is the
    ``data`` column: parse with ``envelope="data"``.
    """
    options = {"streamName": stream, "region": region, "startingPosition": starting_position}
    return spark.readStream.format(provider).options(**options).load()
