"""Documents packed into sequences as they come, into the tightest of a fixed number of open ones.

A document longer than a sequence is cut from its end, so that only its first piece can be
short. Narrow rows of pieces are dealt evenly over tasks. Each task takes its pieces in an
order that does not go by size, looks a few hundred ahead to begin with the longest of them,
and puts each into the open sequence that it fills best; where none has room, a new one is
opened and, if too many are open, the fullest is closed for good. Open sequences are found by their free space in a bitset: one shift and one lowest
bit for each piece. A task holds its open sequences and nothing else, so a table of any size
needs neither groups nor their sizes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetgauge.llm import words as W
from fleetgauge.llm.memo import PORTION, Chunks, Memo
from fleetgauge.llm.tiles import bound_batches, give_back

# Sequences that a task has open at most. Closed ones are nearly full, so that more hardly help.
OPEN = 1024
# Pieces that come longest first; with as many as may be open, closed sequences would lose room.
AHEAD = 512
# Sequence numbers set aside for a task, as a power of two.
NUMBER_BITS = 33
# Pieces that a worker remembers, and those that are encoded in one call.
REMEMBERED = 200_000
CALL = 2000


class OpenBins:
    """At most ``most`` bins with room, in a bitset whose bit f tells that one has f free."""

    def __init__(self, size: int, most: int):
        self.size, self.most = size, most
        self.free = 0
        self.bins: list[list[int]] = [[] for _ in range(size + 1)]
        self.open = self.made = 0

    def _take(self, free: int) -> int:
        chosen = self.bins[free].pop()
        if not self.bins[free]:
            self.free ^= 1 << free
        self.open -= 1
        return chosen

    def place(self, length: int) -> tuple[int, int]:
        """Put ``length`` where it leaves the least room: the bin's number and the place in it."""
        roomy = self.free >> length
        if roomy:
            free = length + (roomy & -roomy).bit_length() - 1
            chosen = self._take(free)
        else:
            chosen, free = self.made, self.size
            self.made += 1
        left = free - length
        if left:
            if self.open == self.most:
                fullest = (self.free & -self.free).bit_length() - 1
                if fullest >= left:
                    # The bin just filled is the fullest itself, and is closed.
                    return chosen, self.size - free
                self._take(fullest)
            self.bins[left].append(chosen)
            self.free |= 1 << left
            self.open += 1
        return chosen, self.size - free


# What the byte-level pattern tells apart, and the letters after an apostrophe.
SPACE, LETTER, NUMBER, OTHER = range(4)
_OF_CHAR = np.full(256, OTHER, dtype=np.uint8)
for _kind, _name in ((SPACE, r"\s"), (LETTER, r"\p{L}"), (NUMBER, r"\p{N}")):
    _OF_CHAR[[c for c in range(256) if regex.match(_name, chr(c))]] = _kind
SHORT_ENDS, LONG_ENDS = (b"s", b"t", b"m", b"d"), (b"re", b"ve", b"ll")


def pieces(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where the byte-level pattern cuts UTF-8 texts of Latin-1 characters, their bounds among the cuts.

    A run of letters, of numbers or of other signs is a piece, with the blank before it. Of
    white space before it, all but the last character is a piece, and the last one too
    unless it is the blank. An apostrophe that begins a piece takes certain endings with it.
    """
    kind = _OF_CHAR[data]
    lead = np.flatnonzero(data >= 0xC2)
    kind[lead] = kind[lead + 1] = _OF_CHAR[(data[lead + 1] & 0x3F) | (data[lead] << 6)]
    cut = np.ones(len(data) + 1, dtype=bool)
    cut[1:-1] = kind[1:] != kind[:-1]
    cut[bounds] = True
    starts = np.flatnonzero(cut)
    inner = np.zeros(len(data) + 1, dtype=bool)
    inner[bounds] = True
    # Runs of white space that a run of the same text follows.
    ends = starts[1:][(kind[starts[:-1]] == SPACE) & ~inner[starts[1:]]]
    cut[ends - 1] = True
    cut[ends[data[ends - 1] == 0x20]] = False
    marks = np.flatnonzero(cut[:-1] & (data == ord("'")))
    if len(marks):
        padded = np.concatenate([data, np.zeros(3, np.uint8)])
        stop = bounds[np.searchsorted(bounds, marks, side="right")]
        # A mark by itself; where signs follow, it is one of them.
        alone = cut[marks + 1]
        for endings in (SHORT_ENDS, LONG_ENDS):
            size = len(endings[0])
            fits = np.zeros(len(marks), dtype=bool)
            for ending in endings:
                fits |= np.logical_and.reduce([padded[marks + 1 + k] == byte for k, byte in enumerate(ending)])
            own = marks[alone & fits & (marks + 1 + size <= stop)]
            cut[own + 1] = False
            cut[own + 1 + size] = True
    return np.flatnonzero(cut)


class Pieces(Chunks):
    """The pieces of some texts, each distinct one to be looked up once."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        cuts = pieces(data, bounds)
        column = pa.Array.from_buffers(pa.string(), len(cuts) - 1, [None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(data)])
        coded = column.dictionary_encode()
        self.distinct = coded.dictionary.to_pylist()
        self.codes = coded.indices.to_numpy()
        self.bounds = np.searchsorted(cuts, bounds)


class ByteTokenizer:
    """A byte-level tokenizer of the ``tokenizers`` library, asked once for each new piece of text.

    Only texts of Latin-1 are cut into pieces here. Others, those with an added token and
    those with separators that libraries do not agree about go to the library whole.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        import json

        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        how = described["pre_tokenizer"]
        if described["normalizer"] or how["type"] != "ByteLevel" or how["add_prefix_space"] or not how["use_regex"]:
            raise ValueError("not a tokenizer that cuts texts by the byte-level pattern alone")
        self.added = [token["content"] for token in described["added_tokens"]]
        # A character of the vocabulary stands for a byte.
        vocabulary = sorted(self.whole.get_vocab(with_added_tokens=False).items(), key=lambda item: item[1])
        self.sizes = np.zeros(vocabulary[-1][1] + 1, dtype=np.int64)
        self.sizes[[number for _, number in vocabulary]] = [len(token) for token, _ in vocabulary]
        self.known = Memo(remembered)

    def _library(self, texts: list[str]) -> list[bytes]:
        found = self.whole.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(f.ids, dtype="<u4").tobytes() for f in found]

    def _joined(self, own: list[str], between: str) -> None:
        """Pieces that stay apart when they follow each other, in one call of the library for many.

        The bytes of the tokens tell where a piece ends.
        """
        for low in range(0, len(own), CALL):
            part = own[low : low + CALL]
            ids = np.frombuffer(self._library([between.join(part)])[0], "<u4")
            sizes = np.array([len(piece.encode()) for piece in part])
            stops = np.cumsum(sizes + len(between)) - len(between)
            ends = np.cumsum(self.sizes[ids])
            first, last = np.searchsorted(ends, stops - sizes, side="right"), np.searchsorted(ends, stops)
            if not np.array_equal(ends[last], stops):
                raise ValueError("the tokenizer joins pieces")
            data = ids.tobytes()
            spans = zip((first * 4).tolist(), (last * 4 + 4).tolist())
            self.known.young.update(zip(part, [data[a:b] for a, b in spans]))

    def _learn(self, distinct: list[str]) -> None:
        self.known.turn()
        fresh = self.known.unknown(set(distinct))
        blank, word, other = [], [], []
        for piece in fresh:
            head = piece[0]
            (blank if head == " " and len(piece) > 1 and piece[1] != " " and not piece[1].isspace() else other if head.isspace() or head == "'" else word).append(piece)
        # A blank or a line's end before it begins a piece, whatever came before.
        self._joined(blank, "")
        self._joined(word, "\n")
        self.known.young.update(zip(other, self._library(other)))

    def _plain(self, text: str) -> bool:
        if not text.isascii():
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                return False
            if "\x85" in text or "\xa0" in text:
                return False
        return not any(c in text for c in "\x1c\x1d\x1e\x1f") and not any(token in text for token in self.added)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        plain = [self._plain(text) for text in texts]
        own = Pieces(*W.text_buffers(pa.array([text for text, fits in zip(texts, plain) if fits], pa.string())))
        self._learn(own.distinct)
        found = iter(own.put_together(self.known.young))
        rest = iter(self._library([text for text, fits in zip(texts, plain) if not fits]))
        return [next(found) if fits else next(rest) for fits in plain]


@lru_cache(maxsize=2)
def tokenizer(path: str) -> ByteTokenizer:
    return ByteTokenizer(path)


def _tokenized(path: str, end: int, names: list[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = np.array([end], dtype="<u4").tobytes()
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            for low, high in W.slices(texts, PORTION):
                own = [t or "" for t in texts.slice(low, high - low).to_pylist()]
                ids = [data + last for data in tokenizer(path).encode(own)]
                yield pa.RecordBatch.from_arrays([keys.slice(low, high - low), pa.array(ids, pa.binary())], names=names)
                del own, ids
                give_back()

    return run


def tokenize(docs: DataFrame, path: str, end: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``ids``: each text's token ids and then ``end``, four bytes an id.

    A null text counts as empty and has ``end`` alone. One row for each row, repeated ones
    included; other columns are not read, so they may have any name.
    """
    bound_batches(docs.sparkSession)
    schema = T.StructType([T.StructField("key", docs.schema[key].dataType), T.StructField("ids", T.BinaryType())])
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    rows = rows.mapInArrow(_tokenized(path, end, schema.names), schema)
    return rows.select(F.col("key").alias(key), "ids")


def cut(tokens: DataFrame, size: int, key: str = "doc_id") -> DataFrame:
    """A row for each piece: ``key``, ``piece`` from 0, ``start``, ``length`` and its ``ids``.

    Every piece but a document's first has ``size`` tokens. A row without ids has no piece.
    """
    tokens = tokens.select(key, "ids", F.expr("length(ids) div 4").alias("total")).filter("total > 0")
    tokens = tokens.withColumn("first", F.pmod(F.col("total") - 1, F.lit(size)) + 1)
    pieces = tokens.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(total - 1) div {size}"))).alias("piece"))
    start = F.when(F.col("piece") == 0, 0).otherwise(F.col("first") + (F.col("piece") - 1) * size)
    length = F.when(F.col("piece") == 0, F.col("first")).otherwise(size)
    pieces = pieces.select(key, "ids", F.col("piece").cast("int").alias("piece"), start.cast("long").alias("start"), length.cast("long").alias("length"))
    ids = F.substring("ids", F.col("start").cast("int") * 4 + 1, F.col("length").cast("int") * 4)
    return pieces.select(key, "piece", "start", "length", ids.alias("ids"))


def _placed(at: int, size: int, most: int, names: list[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, base = OpenBins(size, most), TaskContext.get().partitionId() << NUMBER_BITS
        for batch in batches:
            lengths = batch.column(at).to_numpy()
            found = np.empty((len(lengths), 2), dtype=np.int64)
            for low in range(0, len(lengths), AHEAD):
                order = low + np.argsort(-lengths[low : low + AHEAD], kind="stable")
                found[order] = [bins.place(n) for n in lengths[order].tolist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found[:, 0] + base), pa.array(found[:, 1])], names=names)

    return run


def place(pieces: DataFrame, size: int, most_open: int = OPEN) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``; every column given stays.

    ``pieces`` has ``length`` of 1 to ``size`` and no column of the two names. Offsets in a
    sequence have no gaps from 0 on, and none holds more than ``size``. Equal rows are placed
    one by one; a table without rows gives none. A sequence never leaves its task. Rows go
    to tasks in turn, whatever their keys, and inside a task by a hash of their content, so a
    task that runs again places them alike; rows that tie are equal and can stand for each other.
    """
    names = [f"c{i}" for i in range(len(pieces.columns))]
    rows = pieces.toDF(*names).hint("rebalance")
    rows = rows.sortWithinPartitions(F.xxhash64(*names), *names)
    schema = T.StructType([*rows.schema.fields, *T.StructType.fromDDL("sequence_id long, offset long")])
    placed = rows.mapInArrow(_placed(pieces.columns.index("length"), size, most_open, schema.names), schema)
    return placed.toDF(*pieces.columns, "sequence_id", "offset")
