"""Words of many texts at once as 64-bit hashes, straight from Arrow's string buffers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

# Bytes hashed in one go; each of them takes some 40 bytes of working memory.
SEGMENT = 1 << 18

SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_random = np.random.default_rng(20240607)
_BYTE_VALUES = _random.integers(1, 2**63, 256, dtype=np.uint64)
_BYTE_VALUES[ord("A") : ord("Z") + 1] = _BYTE_VALUES[ord("a") : ord("z") + 1]
_CASED_VALUES = _random.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    if _powers.get("size", -1) < size:
        size = max(size, SEGMENT + 1)
        ups = np.full(size, _BASE, dtype=np.uint64)
        downs = np.full(size, _INVERSE, dtype=np.uint64)
        ups[0] = downs[0] = 1
        _powers.update(size=size, ups=np.cumprod(ups), downs=np.cumprod(downs))
    return _powers["ups"], _powers["downs"]


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and bounds of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    if len(column) == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    _, bounds, data = column.buffers()
    bounds = np.frombuffer(bounds, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or bounds[-1] == bounds[0]:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    data = np.frombuffer(data, dtype=np.uint8)[bounds[0] : bounds[-1]]
    return data, bounds - bounds[0]


def _segments(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cuts of the bytes at white space or between texts, so that they divide no word."""
    start, size = 0, len(data)
    while start < size:
        stop = min(start + SEGMENT, size)
        while stop < size and not SPACES[data[stop]]:
            ahead = np.flatnonzero(SPACES[data[stop : stop + 65536]])
            edge = int(bounds[np.searchsorted(bounds, stop)])
            stop = min(stop + (int(ahead[0]) if len(ahead) else 65536), edge, size)
            if stop == edge:
                break
        yield start, stop
        start = stop


_WORDS = np.where(SPACES, 0, 1).astype(np.uint8)


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and the words before each text's first and after its last.

    A word is a run of bytes other than ASCII white space; A-Z count as a-z.
    """
    return run_hashes(data, bounds, _WORDS, fold_case=True)


def run_hashes(
    data: np.ndarray, bounds: np.ndarray, kinds: np.ndarray, fold_case: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """The same for runs of bytes of one kind; white space has kind 0 and is left out.

    Runs of two texts are never joined.
    """
    values = _BYTE_VALUES if fold_case else _CASED_VALUES
    hashes, starts = [], []
    edges = np.unique(bounds)
    for low, high in _segments(data, bounds):
        part = data[low:high]
        kind = kinds[part]
        turns = np.ones(len(part) + 1, dtype=bool)
        turns[1:-1] = kind[1:] != kind[:-1]
        turns[edges[np.searchsorted(edges, low) : np.searchsorted(edges, high)] - low] = True
        cuts = np.flatnonzero(turns)
        inside = kind[cuts[:-1]] != 0
        first, last = cuts[:-1][inside], cuts[1:][inside]
        ups, downs = _power_tables(len(part) + 1)
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(values[part] * ups[: len(part)], out=sums[1:])
        lengths = (last - first).astype(np.uint64)
        hashes.append(mix((sums[last] - sums[first]) * downs[first] + lengths * np.uint64(0xD1342543DE82EF95)))
        starts.append(first + low)
    if not hashes:
        return np.zeros(0, dtype=np.uint64), np.zeros(len(bounds), dtype=np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), bounds)


_ORDERED = _random.integers(1, 2**63, 65, dtype=np.uint64) | np.uint64(1)


def shingle_hashes(words: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``size`` words of each text, and the bounds of the texts' runs.

    A text with fewer words has one run, all its words; one without words has none.
    """
    lengths = np.diff(bounds)
    counts = np.where(lengths >= size, lengths - size + 1, np.minimum(lengths, 1))
    out_bounds = np.concatenate([[0], np.cumsum(counts)])
    total = np.zeros(max(len(words) - size + 1, 0), dtype=np.uint64)
    for k in range(size):
        total += words[k : k + len(total)] * _ORDERED[k % 64]
    whole = np.zeros(len(words) + 1, dtype=bool)
    long = lengths >= size
    # +1 where a text's runs begin, -1 where they end.
    turns = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(turns, bounds[:-1][long], 1)
    np.add.at(turns, bounds[1:][long] - size + 1, -1)
    whole = np.cumsum(turns)[: len(total)] > 0
    out = np.empty(out_bounds[-1], dtype=np.uint64)
    short = np.flatnonzero(counts.astype(bool) & ~long)
    slots = np.ones(len(out), dtype=bool)
    slots[out_bounds[short]] = False
    out[slots] = mix(total[whole])
    for i in short:
        own = words[bounds[i] : bounds[i + 1]]
        with np.errstate(over="ignore"):
            out[out_bounds[i]] = mix((own * _ORDERED[: len(own)]).sum(keepdims=True) + np.uint64(len(own)) * _ORDERED[64])[0]
    return out, out_bounds


def distinct_per_text(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's hashes in ascending order without repeats, and their bounds."""
    values, _, bounds = counted_per_text(hashes, bounds)
    return values, bounds


def counted_per_text(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each text's distinct hashes, how often it has each, and their bounds."""
    hashes = hashes.copy()
    for low, high in zip(bounds[:-1], bounds[1:]):
        hashes[low:high].sort()
    new = np.ones(len(hashes) + 1, dtype=bool)
    new[1:-1] = hashes[1:] != hashes[:-1]
    new[bounds[:-1]] = True
    at = np.flatnonzero(new)
    return hashes[new[:-1]], np.diff(at), np.searchsorted(at, bounds)


def slices(column: pa.Array, size: int = 8 * SEGMENT) -> Iterator[tuple[int, int]]:
    """Runs of rows with about ``size`` bytes of text each."""
    lengths = column.fill_null("").cast(pa.large_string())
    lengths = pa.compute.binary_length(lengths).to_numpy(zero_copy_only=False)
    pile = np.cumsum(lengths) // size
    cuts = np.flatnonzero(np.diff(pile)) + 1
    edges = [0, *cuts.tolist(), len(column)]
    return zip(edges[:-1], edges[1:])
