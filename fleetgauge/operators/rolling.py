"""Quantiles of the last rows of a chain, kept in order while the frame moves.

Each row adds one value to a sorted list and takes one out: a search by halves, of the
logarithm of the frame in comparisons, and a move of the values behind it, eight bytes
each. Nothing is sorted again. A task streams over its ordered rows and holds one frame
per column, whatever a split or a device holds.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import deque
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from fleetgauge.operators.ordered import CHAIN, POSITION, SPLIT


class Frame:
    """The values of the last ``rows`` rows; a missing one takes a place and has no rank."""

    def __init__(self, rows: int):
        self.rows = rows
        self.last: deque[float | None] = deque()
        self.sorted: list[float] = []

    def clear(self) -> None:
        self.last.clear()
        self.sorted.clear()

    def push(self, value: float | None) -> None:
        if len(self.last) == self.rows:
            gone = self.last.popleft()
            if gone is not None:
                del self.sorted[bisect_left(self.sorted, gone)]
        self.last.append(value)
        if value is not None:
            insort(self.sorted, value)

    def quantile(self, probability: float) -> float | None:
        """Linearly interpolated between the two nearest ranks."""
        if not self.sorted:
            return None
        place = (len(self.sorted) - 1) * probability
        rank = int(place)
        low = self.sorted[rank]
        high = self.sorted[rank + 1] if rank + 1 < len(self.sorted) else low
        return low + (high - low) * (place - rank)


def _turns(batch: pa.RecordBatch, before: tuple | None) -> tuple[list[bool], tuple]:
    """Whether a row begins another group than the row before it."""
    groups = list(zip(batch.column(SPLIT).to_pylist(), batch.column(CHAIN).to_pylist()))
    return [now != then for now, then in zip(groups, [before, *groups])], groups[-1]


def _streamed(columns: Sequence[str], rows: int, probabilities: Sequence[float], names: Sequence[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frames, group = [Frame(rows) for _ in columns], None
        for batch in batches:
            if not batch.num_rows:
                continue
            turns, group = _turns(batch, group)
            found = []
            for column, frame in zip(columns, frames):
                each: list[list[float | None]] = [[] for _ in probabilities]
                for value, turn in zip(batch.column(column).to_pylist(), turns):
                    if turn:
                        frame.clear()
                    frame.push(None if value is None or value != value else value)
                    for out, probability in zip(each, probabilities):
                        out.append(frame.quantile(probability))
                found += [pa.array(out, pa.float64()) for out in each]
            yield pa.RecordBatch.from_arrays([*batch.columns, *found], names=list(names))

    return run


def rolling_quantiles(
    complete: DataFrame, columns: Sequence[str], rows: int, probabilities: Sequence[float]
) -> DataFrame:
    """Add ``_<column>_<k>`` for the k-th probability over each row and the ``rows - 1`` before it.

    ``complete`` is ordered and has, for each (split, chain), the rows its frames reach back to.
    """
    added = [T.StructField(f"_{c}_{k}", T.DoubleType()) for c in columns for k in range(len(probabilities))]
    schema = T.StructType([*complete.schema.fields, *added])
    streamed = complete.repartition(SPLIT, CHAIN).sortWithinPartitions(SPLIT, CHAIN, POSITION)
    return streamed.mapInArrow(_streamed(columns, rows, probabilities, schema.names), schema)
