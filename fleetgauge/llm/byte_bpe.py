"""Byte-level BPE by the ranks of a public vocabulary, and back.

Each piece of the pattern is merged on its own. A segment tree over the piece's byte
positions holds, at its root, the leftmost of the pairs with the smallest rank; a merge
changes three leaves (the merged pair, its right half, the neighbour to the left), each
a walk up the tree. Short pieces go through many trees of one size at once, level by
level in numpy; long ones through a tree of their own. Pieces and blank-separated chunks
met before are remembered, up to a fixed number.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetgauge.llm import words as W
from fleetgauge.llm.memo import Chunks, Memo
from fleetgauge.llm.tiles import bound_batches

NONE = np.iinfo(np.int64).max
# Pieces up to this many bytes are merged in trees side by side.
SIDE_BY_SIDE = 64
TREES = 1 << 13
REMEMBERED = 80_000
# Bytes of text that are encoded together; encoding and decoding share an executor.
PORTION = 1 << 21

# Letters of Latin-1, and at most one sign of ASCII after them.
SIMPLE = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\[-`{-~]?)")
# A blank next to other white space.
BLANKS = re.compile(r" (?:\s|(?<=\s ))")


class Vocabulary:
    """Ranks of byte strings; a token's id is its rank."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            pairs = (line.split() for line in lines if line.strip())
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.bytes = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        merges = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    merges[left << 32 | right] = rank
        self.merges = merges
        self.keys = np.array(sorted(merges), dtype=np.int64)
        self.merged = np.array([merges[k] for k in self.keys.tolist()], dtype=np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where((self.keys[at] == keys) & (left >= 0) & (right >= 0), self.merged[at], -1)

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def merge_long(piece: bytes, vocab: Vocabulary) -> list[int]:
    """Ids of one piece, through one segment tree."""
    size = len(piece)
    ids = vocab.bytes[np.frombuffer(piece, dtype=np.uint8)].tolist()
    leaves = 1 << max(size - 1, 1).bit_length()
    after, before = list(range(1, size + 1)), list(range(-1, size - 1))
    merges = vocab.merges

    def leaf(at: int) -> tuple[int, int]:
        right = after[at]
        rank = merges.get(ids[at] << 32 | ids[right]) if right < size else None
        return (NONE, at) if rank is None else (rank, at)

    tree = [(NONE, size)] * (2 * leaves)
    tree[leaves : leaves + size] = [leaf(at) for at in range(size)]
    for node in range(leaves - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])

    def update(at: int, value: tuple[int, int]) -> None:
        node = leaves + at
        tree[node] = value
        while node > 1:
            node >>= 1
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

    while tree[1][0] != NONE:
        rank, at = tree[1]
        right = after[at]
        ids[at] = rank
        after[at] = after[right]
        if after[at] < size:
            before[after[at]] = at
        update(right, (NONE, right))
        update(at, leaf(at))
        if before[at] >= 0:
            update(before[at], leaf(before[at]))
    out, at = [], 0
    while at < size:
        out.append(ids[at])
        at = after[at]
    return out


def merge_short(pieces: Sequence[bytes], vocab: Vocabulary) -> list[np.ndarray]:
    """Ids of pieces of at most SIDE_BY_SIDE bytes, one segment tree for each, all in step."""
    out: list[np.ndarray] = [None] * len(pieces)
    lengths = np.array([len(p) for p in pieces])
    low = 0
    for leaves in (4, 8, 16, 32, SIDE_BY_SIDE):
        chosen = np.flatnonzero((lengths > low) & (lengths <= leaves))
        low = leaves
        for start in range(0, len(chosen), TREES):
            part = chosen[start : start + TREES]
            ids = _trees([pieces[k] for k in part], lengths[part], leaves, vocab)
            for k, own in zip(part.tolist(), ids):
                out[k] = own
    return out


def _trees(pieces: list[bytes], lengths: np.ndarray, leaves: int, vocab: Vocabulary) -> list[np.ndarray]:
    many = len(pieces)
    data = np.frombuffer(b"".join(p.ljust(leaves, b"\0") for p in pieces), dtype=np.uint8).reshape(many, leaves)
    inside = np.arange(leaves) < lengths[:, None]
    # One row for each position, so that a step over all pieces reads along rows.
    ids = np.ascontiguousarray(np.where(inside, vocab.bytes[data], -1).T)
    final = ids.copy()
    left_of = np.repeat(np.arange(-1, leaves - 1)[:, None], many, axis=1)
    right_of = np.repeat(np.arange(1, leaves + 1)[:, None], many, axis=1)
    tree = np.full((2 * leaves, many), NONE, dtype=np.int64)
    ranks = vocab.pair_ranks(ids[:-1], ids[1:])
    at = np.arange(leaves - 1)[:, None]
    # A leaf orders by rank, then by position: the least one is the leftmost of the least rank.
    tree[leaves:-1] = np.where(ranks >= 0, ranks << 8 | at, NONE)
    for node in range(leaves - 1, 0, -1):
        np.minimum(tree[2 * node], tree[2 * node + 1], out=tree[node])

    column = np.arange(many)  # of a live tree: its piece
    while True:
        live = tree[1] != NONE
        if not live.all():
            done = ~live
            final[:, column[done]] = ids[:, done]
            if not live.any():
                break
            column = column[live]
            ids, left_of, right_of, tree = ids[:, live], left_of[:, live], right_of[:, live], tree[:, live]
        here = np.arange(len(column))
        position, rank = tree[1] & 255, tree[1] >> 8
        right = right_of[position, here]
        beyond = right_of[right, here]
        ids[position, here] = rank
        ids[right, here] = -1
        right_of[position, here] = beyond
        inner = beyond < leaves
        left_of[beyond[inner], here[inner]] = position[inner]
        before = left_of[position, here]
        next_id = np.where(inner, ids[np.minimum(beyond, leaves - 1), here], -1)
        ahead = vocab.pair_ranks(rank, next_id)
        behind = vocab.pair_ranks(np.where(before >= 0, ids[np.maximum(before, 0), here], -1), rank)
        tree[leaves + right, here] = NONE
        tree[leaves + position, here] = np.where(ahead >= 0, ahead << 8 | position, NONE)
        has = before >= 0
        tree[leaves + before[has], here[has]] = np.where(behind >= 0, behind << 8 | before, NONE)[has]
        for changed in (right, position, np.where(has, before, position)):
            node = (leaves + changed) >> 1
            while node[0]:
                tree[node, here] = np.minimum(tree[2 * node, here], tree[2 * node + 1, here])
                node >>= 1
    final = final.T
    kept = final >= 0
    return np.split(final[kept].astype("<u4"), np.cumsum(kept.sum(axis=1))[:-1])


class Encoder:
    """Texts to ids, remembering pieces and the chunks between single blanks."""

    def __init__(self, vocab: Vocabulary, pattern: str, remembered: int = REMEMBERED):
        self.vocab = vocab
        self.pattern = regex.compile(pattern)
        self.pieces, self.chunks = Memo(remembered), Memo(remembered)

    def _learn(self, pieces) -> None:
        self.pieces.turn()
        known = self.pieces
        fresh = known.unknown(pieces)
        short, young = [], known.young
        for piece in fresh:
            data = piece.encode()
            whole = self.vocab.ranks.get(data)
            if whole is not None:
                young[piece] = whole.to_bytes(4, "little")
            elif len(data) > SIDE_BY_SIDE:
                young[piece] = np.array(merge_long(data, self.vocab), dtype="<u4").tobytes()
            else:
                short.append((piece, data))
        for (piece, _), ids in zip(short, merge_short([data for _, data in short], self.vocab)):
            young[piece] = ids.tobytes()

    def _by_pieces(self, texts: Sequence[str]) -> list[bytes]:
        cut = [self.pattern.findall(text) for text in texts]
        self._learn(set().union(*cut))
        ids = self.pieces.young.__getitem__
        return [b"".join(map(ids, own)) for own in cut]

    def _learn_chunks(self, chunks: list[str]) -> None:
        """Ids of chunks with a blank before them; letters, with a sign after them or none, need no search."""
        known = self.chunks
        known.turn()
        fresh = known.unknown(set(chunks))
        cut = []
        for chunk in fresh:
            simple = SIMPLE.fullmatch(chunk)
            if simple is None:
                cut.append(self.pattern.findall(" " + chunk))
            else:
                cut.append([" " + simple[1], simple[2]] if simple[2] else [" " + chunk])
        self._learn(set().union(*cut))
        ids = self.pieces.young
        known.young.update(
            [(chunk, ids[own[0]] if len(own) == 1 else b"".join([ids[p] for p in own])) for chunk, own in zip(fresh, cut)]
        )

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers.

        A blank between two characters that are no white space begins a piece of its own
        or joins the next one, so the text may be cut before it and each chunk be looked
        up whole. Other white space next to a blank makes the whole text go by pieces.
        """
        plain = [not BLANKS.search(text) for text in texts]
        cut = [text.partition(" ") for text, fits in zip(texts, plain) if fits]
        heads = self._by_pieces([head for head, _, _ in cut])
        tails = pa.array([tail if blank else None for _, blank, tail in cut], pa.string())
        chunks = Chunks(pa.compute.split_pattern(tails, " "))
        self._learn_chunks(chunks.distinct)
        tails = chunks.put_together(self.chunks.young)
        whole = (head + tail for head, tail in zip(heads, tails))
        rest = iter(self._by_pieces([text for text, fits in zip(texts, plain) if not fits]))
        return [next(whole) if fits else next(rest) for fits in plain]


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(vocabulary(path), pattern)


def _encoded(path: str, pattern: str, names: list[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            for low, high in W.slices(texts, PORTION):
                own = [t or "" for t in texts.slice(low, high - low).to_pylist()]
                ids = encoder(path, pattern).encode(own)
                yield pa.RecordBatch.from_arrays([keys.slice(low, high - low), pa.array(ids, pa.binary())], names=names)

    return run


def encode(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``ids``, the text's token ids as little-endian unsigned 32-bit integers.

    A row for each row, repeated ones included; a null or empty text has no ids. Each match
    of ``pattern`` is encoded by itself, without special tokens. Other columns are not read.
    """
    bound_batches(docs.sparkSession)
    schema = T.StructType([T.StructField("key", docs.schema[key].dataType), T.StructField("ids", T.BinaryType())])
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    rows = rows.mapInArrow(_encoded(path, pattern, schema.names), schema)
    return rows.select(F.col("key").alias(key), "ids")


def _decoded(path: str) -> Callable:
    def run(batches):
        for batch in batches:
            vocab = vocabulary(path)
            data = [vocab.decode(np.frombuffer(ids or b"", dtype="<u4")) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(data, pa.binary())], names=[*batch.schema.names, "decoded"])

    return run


def decode(encoded: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key``, ``ids`` and ``decoded``, the bytes that the ids stand for; null ids give none."""
    rows = encoded.select(F.col(key).alias("key"), F.col(ids).alias("ids"))
    rows = rows.mapInArrow(_decoded(path), T.StructType([*rows.schema.fields, T.StructField("decoded", T.BinaryType())]))
    return rows.select(F.col("key").alias(key), F.col("ids").alias(ids), "decoded")
