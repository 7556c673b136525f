"""Maximal periodic runs of words in each text, and the text with repeats taken out.

Words of many texts are sorted into one suffix array, text by text, by doubling; only ties
are sorted again. At each doubling, words that begin a block of that length, counted from
the text's start, know the interval of the array that shares the block. A wavelet tree over
the array finds the block's next occurrences in a window ahead of it, each the least
position of an interval that is not below a bound. Occurrences of a block in a window no
longer than itself are one arithmetic progression, so that three of them tell all.

A run of period q holds a block of at most q words with another occurrence q words on. A
lone occurrence is a candidate by its distance. A progression of difference d means that
the block has period d: the stretch of that period around the block and the one around the
progression begin, or else end, q words apart. Candidates are extended word by word.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetgauge.llm import words as W
from fleetgauge.llm.tiles import bound_batches, give_back

LEAST = 24
TIMES = 3
# Words of the smallest blocks: twice as many fit into the shortest run beside its period.
SMALLEST = 8
# Bytes of text whose words are sorted together.
PORTION = 1 << 21

_KINDS = np.where(W.SPACES, 0, 1).astype(np.uint8)
_ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


class Wavelet:
    """Numbers below ``2 ** bits`` by their bits, the highest first: ones go behind zeros at each level."""

    def __init__(self, numbers: np.ndarray):
        self.size, self.bits = len(numbers), max(int(numbers.max(initial=0)).bit_length(), 1)
        self.levels = []
        for bit in range(self.bits - 1, -1, -1):
            ones = (numbers >> bit & 1).astype(bool)
            packed = np.packbits(np.concatenate([ones, np.zeros(64 + -len(ones) % 64, bool)]), bitorder="little").view("<u8")
            before = np.cumsum(np.bitwise_count(packed), dtype=np.int64)
            before -= np.bitwise_count(packed)
            self.levels.append((packed, before.astype(np.int32), self.size - int(ones.sum())))
            numbers = np.concatenate([numbers[~ones], numbers[ones]])

    @staticmethod
    def _ones(level, at: np.ndarray) -> np.ndarray:
        packed, before, _ = level
        word, rest = at >> 6, (at & 63).astype(np.uint64)
        return before[word] + np.bitwise_count(packed[word] & ~(_ONES << rest)).astype(np.int64)

    def below(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many numbers at ``low`` to ``high`` are less than ``bound``, which is below ``2 ** bits``."""
        count = np.zeros(len(low), dtype=np.int64)
        for k, level in enumerate(self.levels):
            one_low, one_high = self._ones(level, low), self._ones(level, high)
            one = (bound >> (self.bits - 1 - k) & 1).astype(bool)
            count += np.where(one, (high - one_high) - (low - one_low), 0)
            low = np.where(one, level[2] + one_low, low - one_low)
            high = np.where(one, level[2] + one_high, high - one_high)
        return count

    def smallest(self, low: np.ndarray, high: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The number with ``rank`` smaller ones at ``low`` to ``high``."""
        found = np.zeros(len(low), dtype=np.int64)
        for k, level in enumerate(self.levels):
            one_low, one_high = self._ones(level, low), self._ones(level, high)
            zeros = (high - one_high) - (low - one_low)
            one = rank >= zeros
            found |= one.astype(np.int64) << (self.bits - 1 - k)
            rank = np.where(one, rank - zeros, rank)
            low = np.where(one, level[2] + one_low, low - one_low)
            high = np.where(one, level[2] + one_high, high - one_high)
        return found

    def successor(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """The least number at ``low`` to ``high`` that is ``bound`` or more; ``size`` where there is none."""
        out = np.full(len(low), self.size, dtype=np.int64)
        inside = np.flatnonzero(bound < self.size)
        rank = self.below(low[inside], high[inside], bound[inside])
        some = rank < high[inside] - low[inside]
        inside = inside[some]
        out[inside] = self.smallest(low[inside], high[inside], rank[some])
        return out


def suffixes(words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]]:
    """The suffix array of texts whose last word is 0 and no other is; those of a text stay together.

    And for each block length the words that begin a block with a second occurrence in
    their text, and the intervals of the array that share it.
    """
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    bits = int(words.max(initial=0)).bit_length()
    keys, depth = text << bits | words, 1
    if int(text.max(initial=0)).bit_length() + 2 * bits < 64:
        keys, depth = keys << bits | np.append(words[1:], 0), 2
    array = np.argsort(keys)
    keys = keys[array]
    rank = np.empty(len(words), dtype=np.int64)
    slots, first = np.arange(len(words)), None
    blocks = []
    while True:
        # ``slots`` of the array hold suffixes in order of ``keys``; equal keys are a group.
        own = array[slots]
        new = np.ones(len(slots) + 1, dtype=bool)
        new[1:-1] = keys[1:] != keys[:-1]
        first = np.flatnonzero(new)
        sizes = np.diff(first)
        begin = np.repeat(slots[first[:-1]], sizes)
        rank[own] = begin
        tied = np.repeat(sizes > 1, sizes)
        slots, own, begin = slots[tied], own[tied], begin[tied]
        if depth >= SMALLEST and len(own):
            heads = (own - bounds[text[own]]) % depth == 0
            ends = begin + np.repeat(sizes[sizes > 1], sizes[sizes > 1])
            blocks.append((depth, own[heads], begin[heads], ends[heads]))
        if not len(slots):
            return array, blocks
        keys = begin * len(words) + rank[own + depth]
        order = np.argsort(keys)
        keys = keys[order]
        array[slots] = own[order]
        depth *= 2


class Stretches:
    """Longest stretches of a text around given places in which words ``period`` apart are equal."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.known: dict[int, list[tuple[int, int]]] = {}

    def _equal(self, at: int, period: int, step: int) -> int:
        """Words from ``at`` on, or before it, that equal the one ``period`` later."""
        words, n, size = self.words, 0, 32
        while True:
            if step > 0:
                a, b = words[at + n : at + n + size], words[at + n + period : at + n + period + size]
                a = a[: len(b)]
            else:
                low = max(at - n - size, 0)
                a, b = words[low : at - n][::-1], words[low + period : at - n + period][::-1]
            other = np.flatnonzero(a != b)
            if len(other):
                return n + int(other[0])
            n += len(a)
            if len(a) < size:
                return n
            size *= 2

    def around(self, at: int, period: int) -> tuple[int, int]:
        """Start and end of the stretch that holds the words at ``at`` and ``period`` on, or ``at`` twice."""
        known = self.known.setdefault(period, [])
        k = bisect_right(known, (at, len(self.words) + 1)) - 1
        if k >= 0 and known[k][1] - period > at:
            return known[k]
        ahead = self._equal(at, period, 1)
        if not ahead:
            return at, at
        found = at - self._equal(at, period, -1), at + ahead + period
        insort(known, found)
        return found


def _candidates(wavelet: Wavelet, depth: int, low, high, start, stop) -> tuple[np.ndarray, np.ndarray]:
    """The first three occurrences from ``start`` to ``stop``, ``size`` for none."""
    places = []
    for _ in range(3):
        place = wavelet.successor(low, high, start)
        place = np.where(place <= stop, place, wavelet.size)
        places.append(place)
        start = place + 1
    return np.stack(places, axis=1)


def runs_of(words: np.ndarray, bounds: np.ndarray) -> dict[int, list[tuple[int, int, int]]]:
    """Start, length and period of every run, by start and period, of the texts that have any.

    ``words`` are numbers from 1 on; equal numbers are equal words.
    """
    counts = np.diff(bounds)
    ended = np.zeros(len(words) + len(counts), dtype=np.int64)
    ended[np.arange(len(words)) + np.repeat(np.arange(len(counts)), counts)] = words
    bounds = bounds + np.arange(len(bounds))
    array, blocks = suffixes(ended, bounds) if len(words) else (None, [])
    if not blocks:
        return {}
    # Texts in which no block comes twice need no tree.
    many = np.unique(np.searchsorted(bounds, np.concatenate([own for _, own, _, _ in blocks]), side="right") - 1)
    sizes = np.diff(bounds)[many]
    shift = np.zeros(len(bounds), dtype=np.int64)
    inner = np.concatenate([[0], np.cumsum(sizes)])
    shift[many] = inner[:-1] - bounds[many]
    taken = np.concatenate([array[bounds[t] : bounds[t + 1]] + shift[t] for t in many.tolist()])
    wavelet = Wavelet(taken)
    stretches: dict[int, Stretches] = {}
    found: dict[int, dict[tuple[int, int], int]] = {}
    for depth, own, low, high in blocks:
        text = np.searchsorted(bounds, own, side="right") - 1
        at, low, high = own + shift[text], low + shift[text], high + shift[text]
        windows = [(at + depth, at + 2 * depth - 1)]
        if depth < 2 * SMALLEST:
            # Blocks of the smallest size serve shorter periods too.
            windows = [(at + 1, at + depth), (at + depth + 1, at + 2 * depth - 1)]
        for start, stop in windows:
            places = _candidates(wavelet, depth, low, high, start, stop)
            for k in np.flatnonzero(places[:, 0] < wavelet.size).tolist():
                t = int(text[k])
                if t not in stretches:
                    stretches[t] = Stretches(ended[bounds[t] : bounds[t + 1] - 1])
                    found[t] = {}
                here, base = stretches[t], int(inner[np.searchsorted(many, t)])
                x = int(at[k]) - base
                first, second, third = (int(p) - base if p < wavelet.size else -1 for p in places[k])
                periods = {first - x} if second < 0 else {first - x, second - x}
                if third >= 0:
                    a, b = here.around(x, second - first), here.around(first, second - first)
                    periods |= {b[0] - a[0], b[1] - a[1]} if a != b else set()
                for period in periods:
                    if not 0 < period < 2 * depth:
                        continue
                    low_end, high_end = here.around(x, period)
                    if high_end - low_end >= max(LEAST, TIMES * period):
                        spans = found[t]
                        spans[low_end, high_end] = min(period, spans.get((low_end, high_end), period))
    out = {}
    for t, spans in found.items():
        if spans:
            out[t] = sorted((s, e - s, period) for (s, e), period in spans.items())
    return out


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run has after its first period."""
    keep = np.ones(len(words), dtype=bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return list(compress(words, keep.tolist()))


def _found(names: list[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            for low, high in W.slices(texts, PORTION):
                own = texts.slice(low, high - low)
                data, ends = W.text_buffers(own)
                hashes, bounds = W.run_hashes(data, ends, _KINDS)
                numbers = np.unique(hashes, return_inverse=True)[1] + 1
                runs = runs_of(numbers, bounds)
                collapsed = []
                for k, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist())):
                    words = data[a:b].tobytes().split()
                    collapsed.append(b" ".join(collapse(words, runs[k]) if k in runs else words))
                rows = [runs.get(k, ()) for k in range(len(own))]
                flat = np.array([r for row in rows for r in row], dtype=np.int64).reshape(-1, 3)
                structs = pa.StructArray.from_arrays([pa.array(c) for c in flat.T], names=["start", "length", "period"])
                offsets = np.concatenate([[0], np.cumsum([len(row) for row in rows])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.slice(low, high - low),
                        pa.array(np.diff(bounds)),
                        pa.ListArray.from_arrays(offsets, structs),
                        pa.array(collapsed, pa.binary()).cast(pa.string()),
                    ],
                    names=names,
                )
                give_back()

    return run


def find_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_words``, ``runs`` (start, length, period) and ``collapsed`` of every row.

    A run is a stretch of words with smallest period q, of LEAST words and TIMES q or more,
    that no neighbouring word extends. Words are divided by ASCII white space and told apart
    by case; ``collapsed`` has those that no run holds after its first q, joined by a blank.
    A null text counts as empty and has no words. One row for each row, repeated ones
    included; other columns are not read, so they may have any name.
    """
    bound_batches(docs.sparkSession)
    runs = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    schema = T.StructType([T.StructField("key", docs.schema[key].dataType), *T.StructType.fromDDL(runs)])
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    rows = rows.mapInArrow(_found(schema.names), schema)
    return rows.toDF(key, "n_words", "runs", "collapsed")


def strongest(runs: str) -> Column:
    """The run with the greatest length by period, the first of equal ones; null for none."""
    first = F.get(runs, F.lit(0))
    rest = F.slice(runs, 2, F.greatest(F.size(runs), F.lit(1)))
    return F.aggregate(
        rest,
        first,
        lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best),
    )
