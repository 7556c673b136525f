"""Between bus messages and readings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetgauge.schema import KEY, READING, READING_COLUMNS


def to_messages(
    df: DataFrame, columns: Sequence[str] = READING_COLUMNS, keep: Sequence[str] = ()
) -> DataFrame:
    """One keyed JSON message per reading; NULL fields are written out, not omitted."""
    return df.select(
        *keep,
        F.col(KEY).cast("string").alias("key"),
        F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("value"),
    )


def parse_messages(
    df: DataFrame,
    envelope: str = "value",
    schema: T.StructType = READING,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Decode the envelope and flatten it, plus ``malformed`` and the source ``text``.

    A field of the wrong type is NULL and the rest of the row survives. Text that is
    not one whole JSON object leaves every field NULL and is marked ``malformed``: the
    parser stops after the first value it finds, so the text is read as the only item of a
    list, which anything after it breaks or makes longer.
    ``envelope`` is ``value`` on one bus and ``data`` on the other.

    The items come out of a generator rather than a projection: a filter on a parsed
    field then stays above it, where a projection would be merged into the filter and
    the text parsed again for every field the filter mentions.
    """
    text = F.col(envelope).cast("string")
    items = F.from_json(F.concat(F.lit("["), F.col("text"), F.lit("]")), T.ArrayType(schema))
    first = F.get("_items", F.lit(0))
    whole = F.trim("text").startswith("{") & (F.size("_items") == 1) & first.isNotNull()
    return (
        df.select(*keep, text.alias("text"))
        .select(*keep, "text", F.explode(F.array(items)).alias("_items"))
        .withColumn("malformed", ~F.coalesce(whole, F.lit(False)))
        .select(
            *keep,
            "text",
            *[F.when(~F.col("malformed"), first[name]).alias(name) for name in schema.fieldNames()],
            "malformed",
        )
    )


def well_formed(parsed: DataFrame) -> DataFrame:
    return parsed.filter(~F.col("malformed")).drop("malformed", "text")


def malformed(parsed: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The reject table: broken text kept as it came."""
    return parsed.filter("malformed").select(*keep, "text")


def with_reject_text(parsed: DataFrame) -> DataFrame:
    """All rows; the text is kept only where nothing else of the message was readable."""
    return parsed.withColumn("text", F.when(F.col("malformed"), F.col("text"))).drop("malformed")


def stamp_collected(df: DataFrame, clock: Column | None = None) -> DataFrame:
    """Stamp arrival time; ``clock`` replaces the wall clock in tests."""
    now = clock if clock is not None else F.current_timestamp()
    return df.withColumn(
        "collected_at", F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    )
