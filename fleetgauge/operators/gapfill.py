"""Fill a missing metric from the device's previous readings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetgauge.operators.ordered import (
    CHAIN,
    HALO,
    POSITION,
    SPLIT,
    SPLIT_BITS,
    chain_window,
    in_order,
    split_window,
    with_halo,
)
from fleetgauge.schema import KEY, METRICS


def _any_gap(ordered: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Last value before the row, from its own split or else carried from earlier ones.

    The carried values are one row per split and chain. The rows are already hashed on
    that pair for the window, so the join adds no shuffle of the big side.
    """
    ends = ordered.groupBy(SPLIT, CHAIN).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(POSITION))).alias(c) for c in columns]
    )
    carried = ends.select(
        SPLIT,
        CHAIN,
        *[F.last(c, ignorenulls=True).over(chain_window()).alias(f"_carry_{c}") for c in columns],
    )
    before = split_window().rowsBetween(Window.unboundedPreceding, -1)
    local = ordered.withColumns(
        {f"_local_{c}": F.last(c, ignorenulls=True).over(before) for c in columns}
    )
    joined = local.join(carried, [SPLIT, CHAIN], "left")
    return joined.withColumns(
        {f"_before_{c}": F.coalesce(f"_local_{c}", f"_carry_{c}") for c in columns}
    )


def _short_gap(
    ordered: DataFrame, columns: Sequence[str], max_gap: int, split_bits: int
) -> DataFrame:
    frame = split_window().rowsBetween(-max_gap, -1)
    complete = with_halo(ordered, max_gap, columns, split_bits)
    return complete.withColumns(
        {f"_before_{c}": F.last(c, ignorenulls=True).over(frame) for c in columns}
    ).filter(~F.col(HALO))


def fill_previous(
    df: DataFrame,
    columns: Sequence[str] = METRICS,
    order: Sequence[str] = ("event_ts", "collected_ts"),
    key: str = KEY,
    max_gap: int | None = None,
    split_bits: int = SPLIT_BITS,
) -> DataFrame:
    """NULL metrics take the device's last known value; known values never change.

    ``max_gap=1`` looks back one row only and so leaves the second row of a longer gap
    open. Rows without a key or event time have no place in the order and pass
    through as they are.
    """
    if max_gap is not None and max_gap < 1:
        raise ValueError("max_gap must be at least 1")
    ordered = in_order(df, order, key, split_bits)
    if max_gap is None:
        looked_back = _any_gap(ordered, columns)
    else:
        looked_back = _short_gap(ordered, columns, max_gap, split_bits)
    placed = F.col(CHAIN).isNotNull()
    return looked_back.withColumns(
        {c: F.coalesce(F.col(c), F.when(placed, F.col(f"_before_{c}"))) for c in columns}
    ).select(*df.columns)
