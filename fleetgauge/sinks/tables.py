"""Batch writes: routed tables, reports, snapshots, compaction."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge.functions.messages import to_messages
from fleetgauge.operators.metrics import exposition_lines
from fleetgauge.schema import KEY

LAYOUT = ("route", "ymdh", KEY)
# A staging table is read back by hour only; fewer folders mean fewer small files.
STAGING_LAYOUT = ("route", "ymdh")
RAW_LAYOUT = (KEY, "year", "month", "day")


def packed(df: DataFrame, layout: Sequence[str] = LAYOUT) -> DataFrame:
    """Bring each partition's rows together for the write, at a sane file size.

    ``rebalance`` lets adaptive execution split a partition that holds too much and
    merge small ones; hashing on the layout alone would put a busy hour in one task.
    """
    return df.hint("rebalance", *layout)


def write_partitioned(
    df: DataFrame,
    path: str,
    layout: Sequence[str] = LAYOUT,
    fmt: str = "parquet",
    mode: str = "append",
    compression: str | None = None,
    replace_partitions: bool = False,
) -> None:
    """One write for all partitions at once.

    With ``replace_partitions`` only the partitions present in ``df`` are replaced,
    which makes a repeated write harmless.
    """
    writer = packed(df, layout).write.partitionBy(*layout).format(fmt)
    if compression:
        writer = writer.option("compression", compression)
    if replace_partitions:
        writer = writer.option("partitionOverwriteMode", "dynamic")
        mode = "overwrite"
    writer.mode(mode).save(path)


def write_raw_archive(df: DataFrame, path: str, mode: str = "append") -> None:
    """Raw readings as gzip Parquet by device and date; needs the calendar columns."""
    write_partitioned(df, path, RAW_LAYOUT, mode=mode, compression="gzip")


def write_cleansed(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "append") -> None:
    write_partitioned(df, path, (KEY,), fmt=fmt, mode=mode)


def write_reports(reports: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Text reports under date, hour and device; a rerun of an hour replaces it."""
    write_partitioned(
        reports, path, ("ymd", "hh", "device"), fmt="text", mode=mode, replace_partitions=True
    )


def write_snapshot(snapshot: DataFrame, path: str) -> None:
    """Replace the gauge table, so that gauges without a value are gone."""
    snapshot.write.mode("overwrite").parquet(path)


def write_exposition(snapshot: DataFrame, path: str) -> None:
    exposition_lines(snapshot).write.mode("overwrite").text(path)


def write_if_any(df: DataFrame, write: Callable[[DataFrame], None]) -> bool:
    """Write unless there is nothing to; the rows are worked out once, and looked at before the write."""
    rows = df.persist()
    try:
        if rows.isEmpty():
            return False
        write(rows)
        return True
    finally:
        rows.unpersist()


def bus_messages(df: DataFrame) -> DataFrame:
    """What the bus takes: ``key`` and ``value``, both text, and nothing else.

    A reading without a device has no key; the bus spreads such messages evenly.
    """
    return to_messages(df).select(F.col("key").cast("string"), F.col("value").cast("string"))


def publish(df: DataFrame, brokers: str, topic: str, fmt: str = "kafka") -> None:
    """Send readings as keyed messages; needs the bus connector on the cluster, whatever its format is called."""
    options = {"kafka.bootstrap.servers": brokers, "topic": topic}
    bus_messages(df).write.format(fmt).options(**options).mode("append").save()


def compact_hours(
    staged: DataFrame, path: str, hours: Sequence[str], layout: Sequence[str] = LAYOUT
) -> None:
    """Rewrite closed hours of a staging table as few large files.

    Replaces whole partitions of the target, so running it again changes nothing. Rows
    without an hour stay in the staging table.
    """
    chosen = staged.filter(F.col("ymdh").isin(*hours)).drop("batch_id")
    write_partitioned(chosen, path, layout, replace_partitions=True)


def register_table(
    spark: SparkSession, table: str, path: str, columns: str, layout: Sequence[str]
) -> None:
    """Declare an external partitioned table over files already written."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
        f"PARTITIONED BY ({', '.join(layout)}) LOCATION '{path}'"
    )
    recover_partitions(spark, table)


def recover_partitions(spark: SparkSession, table: str) -> None:
    """Register every partition folder found, in one command."""
    spark.sql(f"MSCK REPAIR TABLE {table}")


def add_partition(
    spark: SparkSession,
    table: str,
    path: str,
    device: int,
    ymdh: str,
    route: str | None = None,
    layout: Sequence[str] | None = None,
) -> None:
    """Register one partition; repeating it is harmless.

    With a ``route`` the table is of LAYOUT, without one of ``DeviceId=/ymdh=``, unless a
    ``layout`` is given.
    """
    layout = layout or (LAYOUT if route is not None else (KEY, "ymdh"))
    values = {"route": route, "ymdh": ymdh, KEY: int(device)}
    named = ", ".join(f"{level}='{values[level]}'" for level in layout)
    folder = "/".join(f"{level}={values[level]}" for level in layout)
    spark.sql(
        f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({named}) LOCATION '{path.rstrip('/')}/{folder}'"
    )
