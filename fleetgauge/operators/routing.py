"""Split readings into good, out-of-range, device-fault and unrouted rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge.functions.predicates import is_route, route_of, valid_range
from fleetgauge.rules import FLEET_RANGES, Range


def flag_valid(df: DataFrame, rules: Iterable[Range] = FLEET_RANGES) -> DataFrame:
    return df.withColumn("valid", valid_range(rules))


def take_route(df: DataFrame, route: str, rules: Iterable[Range] = FLEET_RANGES) -> DataFrame:
    """One route as a filter, so that it reaches the scan."""
    return df.filter(is_route(route, rules))


def with_route(
    df: DataFrame, rules: Iterable[Range] = FLEET_RANGES, reject: Column | None = None
) -> DataFrame:
    """Every row with its route; ``reject`` marks rows that no table can hold."""
    return df.withColumn("route", route_of(rules, reject))


def route_counts(df: DataFrame) -> DataFrame:
    return with_route(df).groupBy("route").agg(F.count("*").alias("readings"))
