"""Landed files: JSON lines, and the routed hourly table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetgauge.functions.timeparts import check_hour
from fleetgauge.schema import KEY, READING

# A landing folder of the form year/month/day/hour.
HOURLY_GLOB = "*/*/*/*/*.json"

# The routed table, partition columns last; `text` holds payloads that could not be
# read. Hour keys stay text: left to inference they would come back as numbers.
ROUTED = T.StructType(
    [f for f in READING.fields if f.name != KEY]
    + [
        T.StructField("event_ts", T.TimestampType()),
        T.StructField("collected_ts", T.TimestampType()),
        T.StructField("text", T.StringType()),
        T.StructField("route", T.StringType()),
        T.StructField("ymdh", T.StringType()),
        T.StructField(KEY, T.IntegerType()),
    ]
)


def json_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType = READING,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """JSON lines as they land, with the declared schema; ``path`` may be a glob."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path)


def text_stream(
    spark: SparkSession, path: str, files_per_trigger: int | None = None
) -> DataFrame:
    """The same lines unparsed, in a ``value`` column, for the malformed-JSON route."""
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path)


def _or_empty(spark: SparkSession, schema: T.StructType, read) -> DataFrame:
    """No such folder yet means no rows yet; any other error is raised."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def landed_json(spark: SparkSession, path: str, schema: T.StructType = READING) -> DataFrame:
    """One object per line; multi-line mode would read one row per file."""
    return _or_empty(spark, schema, lambda: spark.read.schema(schema).json(path))


def landed_hours(
    spark: SparkSession, base: str, hours: Sequence[str], schema: T.StructType = READING
) -> DataFrame:
    """Hour folders ``base/YYYY/MM/DD/HH``; one that has not landed yet adds no rows."""
    folders = [f"{h[:4]}/{h[4:6]}/{h[6:8]}/{h[8:]}" for h in map(check_hour, hours)]
    slices = [landed_json(spark, f"{base}/{folder}", schema) for folder in folders]
    return reduce(DataFrame.unionByName, slices)


def routed_table(spark: SparkSession, path: str, schema: T.StructType = ROUTED) -> DataFrame:
    return _or_empty(spark, schema, lambda: spark.read.schema(schema).parquet(path))


def _any_of(name: str, values: Sequence[str] | None) -> str:
    return f"{name}={{{','.join(values)}}}" if values else f"{name}=*"


def _matching(spark: SparkSession, base: str, pattern: str) -> DataFrame:
    """Only the folders that match are listed, however many the table has."""

    def read() -> DataFrame:
        reader = spark.read.schema(ROUTED).option("basePath", base)
        return reader.parquet(f"{base}/{pattern}")

    return _or_empty(spark, ROUTED, read)


def routed_hours(
    spark: SparkSession, path: str, hours: Sequence[str], routes: Sequence[str] | None = None
) -> DataFrame:
    """Some hours of a routed table, for jobs that run often on a table that is large.

    Hours without files add no rows.
    """
    chosen = _any_of("ymdh", [check_hour(h) for h in hours])
    return _matching(spark, path, f"{_any_of('route', routes)}/{chosen}")


def staged_hours(spark: SparkSession, path: str, hours: Sequence[str]) -> DataFrame:
    """The same hours over all batches of a staging table."""
    chosen = _any_of("ymdh", [check_hour(h) for h in hours])
    return _matching(spark, path, f"batch_id=*/route=*/{chosen}")


def hour_slice(
    table: DataFrame,
    hours: Sequence[str],
    route: str | None = None,
    devices: Sequence[int] | None = None,
) -> DataFrame:
    """Whole hours of a routed table, as partition filters that Spark prunes on.

    An hour without files is an empty result, not an error.
    """
    wanted = F.col("ymdh").isin(*[check_hour(h) for h in hours])
    if route is not None:
        wanted = wanted & (F.col("route") == route)
    if devices is not None:
        wanted = wanted & F.col(KEY).isin(*devices)
    return table.filter(wanted)


def file_listing(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """Paths of a table's files, without opening any of them."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path")
    )
