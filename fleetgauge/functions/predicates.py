"""Rule tables compiled to Spark predicates.

No predicate here hides a NULL: whether a reading with a missing metric is valid
is unknown, and the router depends on that third value.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetgauge.rules import FLEET_RANGES, REJECTED, UNROUTED, Range


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(Column.__and__, conditions)


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(Column.__or__, conditions)


def within(rules: Iterable[Range]) -> Column:
    return all_of(F.col(r.column).between(r.low, r.high) for r in rules)


def valid_range(rules: Iterable[Range] = FLEET_RANGES) -> Column:
    """True, false, or NULL where a missing value leaves it open."""
    return within(rules) & F.col("isFail").isin(True, False)


def is_route(route: str, rules: Iterable[Range] = FLEET_RANGES) -> Column:
    """Filter for one route; a device-reported fault outranks the range check."""
    if route == "fail":
        return F.col("isFail") == F.lit(True)
    healthy = F.col("isFail") == F.lit(False)
    if route == "data":
        return healthy & valid_range(rules)
    if route == "dataerr":
        return healthy & ~valid_range(rules)
    raise ValueError(f"no such route: {route}")


def route_of(rules: Iterable[Range] = FLEET_RANGES, reject: Column | None = None) -> Column:
    """All routes in one pass; rows that no filter takes are named, not lost."""
    rules = tuple(rules)
    expr = F.when(reject, F.lit(REJECTED)) if reject is not None else F
    for route in ("fail", "data", "dataerr"):
        expr = expr.when(is_route(route, rules), F.lit(route))
    return expr.otherwise(F.lit(UNROUTED))


def present(columns: Iterable[str]) -> Column:
    return all_of(F.col(c).isNotNull() for c in columns)


def absent(columns: Iterable[str]) -> Column:
    return any_of(F.col(c).isNull() for c in columns)
