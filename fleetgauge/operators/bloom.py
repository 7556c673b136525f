"""Bloom filters as rows of bitmaps, one filter for each group of keys.

A filter has ``bits`` bits in buckets of 32,768, a row for each bucket in use. Filters of one
group merge by a bitwise or. A key that was put in is always found; another one is found
by mistake as often as all of its bits happen to be set.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bits of a filter, and how many of them a key sets: under one mistake in a thousand up to
# some 70,000 keys of a group.
FILTER_BITS = 1 << 20
HASHES = 4
# Fixed value: bits of one bitmap of Spark's bitmap functions.
BUCKET = 32_768


def filter_schema(group: str) -> str:
    return f"{group} string, bucket bigint, bitmap binary"


def _spread(rows: DataFrame, group: str, keys: Sequence[str], bits: int) -> DataFrame:
    """A row for each bit of each key: its bucket and its place in it."""
    places: list[Column] = [F.pmod(F.xxhash64(F.lit(k), *keys), F.lit(bits)) for k in range(HASHES)]
    spread = rows.select(group, *keys, F.explode(F.array(*places)).alias("_at"))
    return spread.select(group, *keys, F.expr(f"_at div {BUCKET}").alias("bucket"), (F.col("_at") % BUCKET).alias("_bit"))


def build_filters(rows: DataFrame, group: str, keys: Sequence[str], bits: int = FILTER_BITS) -> DataFrame:
    spread = _spread(rows, group, keys, bits)
    return spread.groupBy(group, "bucket").agg(F.bitmap_construct_agg("_bit").alias("bitmap"))


def merge_filters(filters: DataFrame, group: str) -> DataFrame:
    return filters.groupBy(group, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def maybe_known(
    rows: DataFrame, filters: DataFrame, group: str, keys: Sequence[str], bits: int = FILTER_BITS
) -> DataFrame:
    """The distinct keys of ``rows`` whose bits are all set in the filter of their group."""
    spread = _spread(rows.select(group, *keys).distinct(), group, keys, bits)
    byte = F.conv(F.hex(F.substring("bitmap", (F.col("_bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = byte.bitwiseAND(F.element_at(F.array(*[F.lit(1 << k) for k in range(8)]), (F.col("_bit") % 8).cast("int") + 1)) > 0
    found = spread.join(filters, [group, "bucket"]).filter(is_set)
    return found.groupBy(group, *keys).agg(F.count("*").alias("_set")).filter(F.col("_set") == HASHES).drop("_set")
