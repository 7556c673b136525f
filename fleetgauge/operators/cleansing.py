"""Key gate, ingest gate, type rules and null rules."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge.functions.predicates import absent, present, within
from fleetgauge.operators.gapfill import fill_previous
from fleetgauge.rules import (
    DEFAULT_0,
    DEFAULT_FALSE,
    INGEST_RANGES,
    INGEST_REQUIRED,
    INTERPOLATE,
    NULL_RULES,
    REJECT,
    TYPE_RULES,
    TypeRule,
)
from fleetgauge.schema import KEY, MOTORS

REQUIRED_KEYS = ("time", KEY)


def require_keys(df: DataFrame, keys: Sequence[str] = REQUIRED_KEYS) -> DataFrame:
    return df.filter(present(keys))


def alerts(df: DataFrame, keys: Sequence[str] = REQUIRED_KEYS) -> DataFrame:
    """The rows the key gate turns away."""
    return df.filter(absent(keys))


def ingest_gate(df: DataFrame) -> DataFrame:
    """The collector's gate; a NULL field counts as missing."""
    return df.filter(present(INGEST_REQUIRED) & within(INGEST_RANGES))


def cast_motors(df: DataFrame, columns: Sequence[str] = MOTORS) -> DataFrame:
    """Motor speeds to whole numbers, truncating; what does not fit becomes NULL."""
    return df.withColumns({c: F.col(c).try_cast("int") for c in columns})


def _passes(rule: TypeRule) -> Column:
    cast = F.col(rule.column).try_cast(rule.kind)
    if rule.low is None:
        return cast.isNotNull()
    return cast.between(rule.low, rule.high)


def validate_types(df: DataFrame, rules: Iterable[TypeRule] = TYPE_RULES) -> DataFrame:
    """Offending values become NULL; the column keeps its type."""
    return df.withColumns({r.column: F.when(_passes(r), F.col(r.column)) for r in rules})


def handle_nulls(
    df: DataFrame,
    rules: Mapping[str, str] = NULL_RULES,
    order: Sequence[str] = ("event_ts", "collected_ts"),
) -> DataFrame:
    """Drop, default or interpolate NULLs, column by column.

    Defaults are cast to the column's own type: a bare 0 would widen a float.
    Interpolation needs the rows in order, so it is for batches; see ``fill_batch`` for
    streams.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    unknown = set(rules.values()) - {REJECT, DEFAULT_0, DEFAULT_FALSE, INTERPOLATE}
    if unknown:
        raise ValueError(f"unknown null rules: {sorted(unknown)}")
    rejecting = [c for c, rule in rules.items() if rule == REJECT]
    if rejecting:
        df = df.filter(present(rejecting))
    value = {DEFAULT_0: 0, DEFAULT_FALSE: False}
    filled = {
        c: F.coalesce(F.col(c), F.lit(value[rule]).cast(types[c]))
        for c, rule in rules.items()
        if rule in value
    }
    if filled:
        df = df.withColumns(filled)
    gaps = [c for c, rule in rules.items() if rule == INTERPOLATE]
    return fill_previous(df, gaps, order=order) if gaps else df


def cleanse(df: DataFrame) -> DataFrame:
    """Type rules, then null rules: bad metrics become 0, unknown devices vanish."""
    return handle_nulls(validate_types(df))
