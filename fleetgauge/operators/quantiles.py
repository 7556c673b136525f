"""Exact quantiles without sorting or collecting a column.

One sketch pass encloses each wanted rank between two values of the column. One
counting pass finds how many rows lie below, on and between those edges. What lies
between is a thousandth of the rows at most: few enough to be read off in the same
pass, or else written out and searched again. A value that many rows share settles on
an edge and is never gathered.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge.session import materialise

ACCURACY = 10_000
LEAF_ROWS = 50_000
# The sketch is off by at most 1/ACCURACY of the rows, so edges this far to either
# side of a rank enclose it, with at most 2.5 margins of the rows between.
MARGIN = 4 / ACCURACY
INSIDE = 2.5


def known(column: str) -> Column:
    """The value, or NULL where it is missing or not a number."""
    return F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))


@dataclass(frozen=True)
class _Target:
    """Find the values at ``ranks``, counted from 0, among ``size`` values."""

    values: Column
    size: int
    ranks: tuple[int, ...]


@dataclass(frozen=True)
class _Rest:
    """A target still to be searched, and the rank its first value has in the column."""

    index: int
    first: int
    target: _Target


@dataclass(frozen=True)
class _Edges:
    """An open interval; None is an open end."""

    low: float | None = None
    high: float | None = None

    def inside(self, values: Column) -> Column:
        within = values.isNotNull()
        if self.low is not None:
            within = within & (values > self.low)
        if self.high is not None:
            within = within & (values < self.high)
        return F.when(within, values)

    def at_high(self, values: Column) -> Column:
        """On the upper edge, unless both edges are one value."""
        if self.low is None:
            return values == self.high
        return (values == self.high) & (values > self.low)


def _margin(depth: int) -> float:
    """Wider from search to search, so that even a poor sketch leaves ever fewer rows."""
    return min(MARGIN * 4**depth, 0.25)


def _enclosing(shares: Sequence[float], depth: int = 0) -> list[float]:
    low, high = min(shares) - _margin(depth), max(shares) + _margin(depth)
    return [max(low, 0.0), min(high, 1.0)]


def _edges(cut: Sequence[float], wanted: Sequence[float]) -> _Edges:
    """Keep an end open where the wanted share reaches the end of the column."""
    return _Edges(cut[0] if wanted[0] > 0 else None, cut[1] if wanted[1] < 1 else None)


def _propose(
    df: DataFrame, targets: Sequence[_Target], leaf_rows: int, depth: int
) -> list[_Edges]:
    wanted = [_enclosing([r / t.size for r in t.ranks], depth) for t in targets]
    row = df.agg(
        *[
            F.percentile_approx(t.values, w, ACCURACY).alias(f"q{i}")
            for i, (t, w) in enumerate(zip(targets, wanted))
        ]
    ).first()
    return [
        _edges(row[i], w) if t.size > leaf_rows else _Edges()
        for i, (t, w) in enumerate(zip(targets, wanted))
    ]


def _resolve(
    df: DataFrame,
    targets: Sequence[_Target],
    edges: Sequence[_Edges],
    leaf_rows: int,
    depth: int = 0,
) -> list[dict[int, float]]:
    """Values by rank, for each target."""
    share = INSIDE * _margin(depth)
    few = all(
        (t.size if e == _Edges() else t.size * share) <= leaf_rows for t, e in zip(targets, edges)
    )
    wanted = []
    for i, (t, e) in enumerate(zip(targets, edges)):
        inside = e.inside(t.values)
        wanted += [
            F.count_if(t.values < e.low).alias(f"under{i}"),
            F.count_if(t.values == e.low).alias(f"low{i}"),
            F.count(inside).alias(f"inside{i}"),
            F.count_if(e.at_high(t.values)).alias(f"high{i}"),
        ]
        if few:
            wanted.append(F.sort_array(F.collect_list(inside)).alias(f"values{i}"))
    counted = df.agg(*wanted)
    starts = [F.col(f"under{i}") + F.col(f"low{i}") for i in range(len(targets))]
    shown = [c for c in counted.columns if not c.startswith("values")]
    if few:
        # The arrays stay in the plan; only the values at the wanted ranks come back.
        for i, t in enumerate(targets):
            shown += [
                F.get(f"values{i}", (F.lit(r) - starts[i]).cast("int")).alias(f"value{i}_{r}")
                for r in t.ranks
            ]
    row = counted.select(*shown).first().asDict()

    found: list[dict[int, float]] = []
    rest: list[_Rest] = []
    for i, (t, e) in enumerate(zip(targets, edges)):
        under, start = row[f"under{i}"], row[f"under{i}"] + row[f"low{i}"]
        stop = start + row[f"inside{i}"]
        over = stop + row[f"high{i}"]
        values = {}
        zones = {"below": [], "inside": [], "above": []}
        for r in t.ranks:
            if r < under:
                zones["below"].append(r)
            elif r < start:
                values[r] = e.low
            elif r >= over:
                zones["above"].append(r)
            elif r >= stop:
                values[r] = e.high
            elif few:
                values[r] = row[f"value{i}_{r}"]
            else:
                zones["inside"].append(r)
        found.append(values)
        # The outer zones are for a sketch that missed; the search stays exact then too.
        for zone, edge, first, size in (
            ("below", _Edges(None, e.low), 0, under),
            ("inside", e, start, stop - start),
            ("above", _Edges(e.high, None), over, t.size - over),
        ):
            if zones[zone]:
                ranks = tuple(r - first for r in zones[zone])
                rest.append(_Rest(i, first, _Target(edge.inside(t.values), size, ranks)))
    if rest:
        results = _search_inside(df, [r.target for r in rest], leaf_rows, depth + 1)
        for r, values in zip(rest, results):
            found[r.index].update({r.first + rank: v for rank, v in values.items()})
    return found


def _search_inside(
    df: DataFrame, targets: Sequence[_Target], leaf_rows: int, depth: int
) -> list[dict[int, float]]:
    """Write out the few values still in question and search among those."""
    tagged = F.array(
        *[F.struct(F.lit(i).alias("target"), t.values.alias("value")) for i, t in enumerate(targets)]
    )
    pairs = df.select(F.inline(tagged)).filter(F.col("value").isNotNull())
    small = materialise(pairs, "quantiles")
    narrowed = [
        _Target(F.when(F.col("target") == i, F.col("value")), t.size, t.ranks)
        for i, t in enumerate(targets)
    ]
    edges = _propose(small, narrowed, leaf_rows, depth)
    return _resolve(small, narrowed, edges, leaf_rows, depth)


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    leaf_rows: int = LEAF_ROWS,
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles per column; NULL and NaN are skipped.

    Two passes over ``df``, or three where a thousandth of it is more than
    ``leaf_rows``. The driver only sees a few numbers per column.
    """
    wanted = [_enclosing([p]) for p in probabilities]
    shares = [share for cut in wanted for share in cut]
    first = []
    for i, c in enumerate(columns):
        first += [
            F.count(known(c)).alias(f"size{i}"),
            F.percentile_approx(known(c), shares, ACCURACY).alias(f"cuts{i}"),
        ]
    row = df.agg(*first).first()
    targets, edges, places = [], [], {}
    for i, c in enumerate(columns):
        size, cuts = row[f"size{i}"], row[f"cuts{i}"]
        if not size:
            continue
        for j, p in enumerate(probabilities):
            place = (size - 1) * p
            ranks = (int(place), min(int(place) + 1, size - 1))
            places[c, p] = (len(targets), place, ranks)
            targets.append(_Target(known(c), size, tuple(sorted(set(ranks)))))
            wide = size > leaf_rows
            edges.append(_edges(cuts[2 * j : 2 * j + 2], wanted[j]) if wide else _Edges())
    if not targets:
        return {c: [None] * len(probabilities) for c in columns}
    found = _resolve(df, targets, edges, leaf_rows)

    def at(c: str, p: float) -> float | None:
        if (c, p) not in places:
            return None
        index, place, (low, high) = places[c, p]
        a, b = found[index][low], found[index][high]
        return a + (b - a) * (place - low)

    return {c: [at(c, p) for p in probabilities] for c in columns}
