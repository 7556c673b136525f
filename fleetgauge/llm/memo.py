"""A bounded memory of what was worked out for a word before."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401


class Memo:
    """Keeps at least the last ``size`` values used and at most twice as many.

    Entries age in two generations: when the young one is full it becomes the old one,
    and old entries that are asked for again move back.
    """

    def __init__(self, size: int):
        self.size = size
        self.young: dict = {}
        self.old: dict = {}

    def unknown(self, keys: set) -> list:
        """Keys without a value; those that have one are in ``young`` afterwards.

        Call ``turn`` before, never between this and reading ``young``.
        """
        young, old = self.young, self.old
        fresh = []
        for key in keys.difference(young):
            value = old.get(key)
            if value is None:
                fresh.append(key)
            else:
                young[key] = value
        return fresh

    def turn(self) -> None:
        if len(self.young) >= self.size:
            self.young, self.old = {}, self.young


# Bytes of text whose chunks are looked up together: the more, the fewer lookups for each.
PORTION = 1 << 23


def strings(column: pa.Array) -> list[str]:
    """Strings without blanks as a list; many times faster than one by one."""
    if not len(column):
        return []
    return pa.compute.binary_join(pa.ListArray.from_arrays([0, len(column)], column), " ")[0].as_py().split(" ")


class Chunks:
    """Blank-free chunks of some texts, each distinct one to be looked up once."""

    def __init__(self, lists: pa.ListArray):
        coded = lists.flatten().dictionary_encode()
        self.distinct = strings(coded.dictionary)
        self.codes = coded.indices.to_numpy()
        self.bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()

    def put_together(self, ids: dict[str, bytes]) -> list[bytes]:
        """Ids of each text's chunks, one after the other; ``ids`` has those of every chunk."""
        known = [ids[c] for c in self.distinct]
        sizes = np.fromiter(map(len, known), np.int32, len(known)) // 4
        table, starts = np.frombuffer(b"".join(known), dtype="<u4"), np.cumsum(sizes, dtype=np.int32) - sizes
        lengths = sizes[self.codes]
        ends = np.cumsum(lengths, dtype=np.int32)
        at = np.repeat(starts[self.codes] - (ends - lengths), lengths)
        at += np.arange(len(at), dtype=np.int32)
        data = table[at].tobytes()
        bounds = (np.concatenate([[0], ends])[self.bounds] * 4).tolist()
        return [data[low:high] for low, high in zip(bounds[:-1], bounds[1:])]
