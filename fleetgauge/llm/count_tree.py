"""R-tree over vectors of group counts, joined with itself or another under an overlap bound."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

LEAF = 32
FAN = 8
# Pairs whose bound is taken at once; each of them holds two count vectors.
CHUNK = 1 << 13


class CountTree:
    """Points are the counts of a set's tokens in each group of a hash.

    A node keeps the largest count of each group and the range of set sizes below it.
    Two sets share at most the sum of the smaller counts of every group; for nodes the
    same sum over their largest counts bounds all pairs below them.
    """

    def __init__(self, counts: np.ndarray, sizes: np.ndarray):
        self.points = np.arange(len(sizes))
        if len(sizes) > LEAF:
            self.points = self._packed(counts, sizes)
        self.levels = [(counts[self.points], sizes[self.points], sizes[self.points])]
        fan = LEAF
        while len(self.levels[-1][1]) > 1:
            top, low, high = self.levels[-1]
            starts = np.arange(0, len(low), fan)
            self.levels.append(
                (np.maximum.reduceat(top, starts), np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts))
            )
            fan = FAN

    @staticmethod
    def _packed(counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Sort-tile order: slabs by set size, inside a slab by the group that varies most."""
        slabs = int(np.ceil(np.sqrt(len(sizes) / LEAF)))
        widest = int(np.argmax(counts.var(axis=0)))
        slab = np.empty(len(sizes), dtype=np.int64)
        slab[np.argsort(sizes, kind="stable")] = np.arange(len(sizes)) * slabs // len(sizes)
        return np.lexsort((counts[:, widest], slab))

    def pairs(self, other: CountTree, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Indices of points that may overlap by ``percent`` of their union, in portions.

        With itself, each pair once and no point with itself.
        """
        same = other is self
        depth = max(len(self.levels), len(other.levels)) - 1
        start = np.zeros(1, dtype=np.int64)
        yield from self._descend(other, percent, same, depth, start, start)

    def _descend(self, other, percent, same, depth, a, b):
        a, b = self._passing(other, percent, depth, a, b)
        if not len(a):
            return
        if depth == 0:
            if same:
                a, b = a[a != b], b[a != b]
            yield self.points[a], other.points[b]
            return
        fan = LEAF if depth == 1 else FAN
        step = max(1, CHUNK // (fan * fan))
        for low in range(0, len(a), step):
            x, y = self._below(depth, fan, a[low : low + step]), other._below(depth, fan, b[low : low + step])
            x, y = np.repeat(x, y.shape[1], axis=1).ravel(), np.tile(y, (1, x.shape[1])).ravel()
            keep = (x < self._size(depth - 1)) & (y < other._size(depth - 1))
            if same:
                keep &= x <= y
            yield from self._descend(other, percent, same, depth - 1, x[keep], y[keep])

    def _size(self, depth: int) -> int:
        return len(self.levels[min(depth, len(self.levels) - 1)][1])

    def _below(self, depth: int, fan: int, nodes: np.ndarray) -> np.ndarray:
        if depth >= len(self.levels):  # the lower of two trees waits at its root
            return nodes[:, None]
        return nodes[:, None] * fan + np.arange(fan)

    def _passing(self, other, percent, depth, a, b):
        top, low, high = self.levels[min(depth, len(self.levels) - 1)]
        top2, low2, high2 = other.levels[min(depth, len(other.levels) - 1)]
        fits = 100 * np.minimum(high[a], high2[b]) >= percent * np.maximum(low[a], low2[b])
        a, b = a[fits], b[fits]
        shared = np.minimum(top[a], top2[b]).sum(axis=1, dtype=np.int64)
        fits = (100 + percent) * shared >= percent * (low[a] + low2[b])
        return a[fits], b[fits]
