"""Documents packed into sequences of a fixed number of tokens.

A document's ids are cut at every full sequence; full pieces are sequences by
themselves. The last pieces of all documents are dealt at random into groups of about
the same number, and each group is packed by itself: pieces in order of size, the
largest first, each into the first open sequence that has room. A tournament tree over
the sequences' free room finds it in a logarithm of their number.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetgauge.llm import words as W
from fleetgauge.llm.memo import PORTION, Chunks, Memo
from fleetgauge.llm.tiles import bound_batches, give_back
from fleetgauge.session import materialise

# Pieces of a group, on average.
GROUP = 1 << 13
REMEMBERED = 150_000
# Sequence numbers set aside for a group.
NUMBERS = 1 << 24
# Pieces that are encoded in one call.
CALL = 2000


class WordTokenizer:
    """A tokenizer whose pieces never span white space, fed with one piece at a time.

    Texts of Latin-1 characters are put in lower case and cut at white space, the chunks
    by the tokenizer's own split pattern; each new piece is encoded once by the library.
    Other texts, those with an added token and those with the separators that libraries do
    not agree about go to the library as they are.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        import json

        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        split = described["pre_tokenizer"]["pretokenizers"][0]
        suffix = described["model"]["end_of_word_suffix"]
        # However they are written: which forms count is left to the library.
        self.added = [t["content"].lower() for t in described["added_tokens"]]
        steps = [s["type"] for s in described["normalizer"]["normalizers"]]
        if steps != ["NFC", "Replace", "Lowercase"] or not suffix:
            raise ValueError("not a lower-case vocabulary with word ends")
        self.pattern = regex.compile(split["pattern"]["Regex"])
        ends = [token.endswith(suffix) for token, _ in sorted(self.whole.get_vocab().items(), key=lambda x: x[1])]
        self.ends = np.array(ends)
        self.known = Memo(remembered)

    def _has_added(self, text: str) -> bool:
        text = text.lower()
        return any(token in text for token in self.added)

    def _library(self, texts: list[str]) -> list[bytes]:
        found = self.whole.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(f.ids, dtype="<u4").tobytes() for f in found]

    def _learn_pieces(self, fresh: list[str]) -> None:
        for low in range(0, len(fresh), CALL):
            part = fresh[low : low + CALL]
            # Blanks are dropped, and the last id of every piece is one with a word end.
            found = self.whole.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0]
            ids = np.array(found.ids, dtype="<u4")
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(part):
                raise ValueError("the tokenizer joins or splits pieces")
            data, stops = ids.tobytes(), (stops * 4).tolist()
            self.known.young.update(zip(part, [data[a:b] for a, b in zip([0, *stops], stops)]))

    def _learn(self, chunks: set) -> None:
        """Ids of Latin-1 chunks: letters alone are a piece, other chunks are put together from theirs."""
        known = self.known
        known.turn()
        fresh = known.unknown(chunks)
        pieces = [c for c in fresh if c.isalpha()]
        # Letters and one sign after them need no search.
        signed = [c for c in fresh if c[:-1].isalpha() and not c[-1].isalnum()]
        others = set(fresh).difference(pieces, signed)
        cut = {c: self.pattern.findall(c) for c in others}
        parts = set().union([c[:-1] for c in signed], [c[-1] for c in signed], *cut.values())
        self._learn_pieces([*pieces, *known.unknown(parts.difference(pieces))])
        ids = known.young
        ids.update([(c, ids[c[:-1]] + ids[c[-1]]) for c in signed])
        ids.update([(c, b"".join([ids[p] for p in own])) for c, own in cut.items()])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        plain = [_plain(text) and not self._has_added(text) for text in texts]
        lower = pa.compute.utf8_lower(pa.array([t for t, fits in zip(texts, plain) if fits], pa.string()))
        # Of white space, plain texts have ASCII's only; an empty chunk at either end has no ids.
        chunks = Chunks(pa.compute.ascii_split_whitespace(lower))
        self._learn(set(chunks.distinct))
        found = iter(chunks.put_together(self.known.young))
        rest = iter(self._library([text for text, fits in zip(texts, plain) if not fits]))
        return [next(found) if fits else next(rest) for fits in plain]


def _plain(text: str) -> bool:
    """Whether lower case and cuts at white space are the same everywhere for this text."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return not any(c in text for c in "\x1c\x1d\x1e\x1f\x85\xa0")


@lru_cache(maxsize=2)
def tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


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


def tokenize(docs: DataFrame, path: str, end: int = 1, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``ids``: each text's token ids and then ``end``, four bytes an id.

    A null text counts as empty and has ``end`` alone. One row for each row; other
    columns are not read.
    """
    bound_batches(docs.sparkSession)
    schema = T.StructType([T.StructField("key", docs.schema[key].dataType), T.StructField("ids", T.BinaryType())])
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    rows = rows.mapInArrow(_tokenized(path, end, schema.names), schema)
    return rows.select(F.col("key").alias(key), "ids")


def cut(tokens: DataFrame, size: int, key: str = "doc_id") -> DataFrame:
    """A row for each piece: ``key``, ``start``, ``length``, ``doc_tokens`` and its ``ids``.

    Every piece but a document's last has ``size`` tokens.
    """
    tokens = tokens.select(key, "ids", (F.length("ids") / 4).cast("long").alias("doc_tokens")).filter("doc_tokens > 0")
    starts = F.sequence(F.lit(0).cast("long"), F.col("doc_tokens") - 1, F.lit(size).cast("long"))
    pieces = tokens.select("*", F.explode(starts).alias("start"))
    length = F.least(F.lit(size), F.col("doc_tokens") - F.col("start"))
    ids = F.substring("ids", F.col("start").cast("int") * 4 + 1, F.lit(size * 4))
    return pieces.select(key, "start", length.alias("length"), "doc_tokens", ids.alias("ids"))


class Tournament:
    """Free room of sequences; a node has the most room of any sequence below it."""

    def __init__(self, bins: int, room: int):
        self.leaves = 1 << max(bins - 1, 1).bit_length()
        self.tree = [0] * (2 * self.leaves)
        self.tree[self.leaves : self.leaves + bins] = [room] * bins
        for node in range(self.leaves - 1, 0, -1):
            self.tree[node] = max(self.tree[2 * node], self.tree[2 * node + 1])

    def place(self, length: int) -> tuple[int, int]:
        """Put ``length`` into the first sequence with room: its number and the room before."""
        tree, node = self.tree, 1
        while node < self.leaves:
            node *= 2
            if tree[node] < length:
                node += 1
        chosen, room = node - self.leaves, tree[node]
        tree[node] = room - length
        while node > 1:
            node >>= 1
            tree[node] = max(tree[2 * node], tree[2 * node + 1])
        return chosen, room


def first_fit_decreasing(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece; pieces of one length keep their order."""
    order = np.argsort(-lengths, kind="stable")
    tree = Tournament(max(len(lengths), 1), size)
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for piece, length in zip(order.tolist(), lengths[order].tolist()):
        sequence[piece], room = tree.place(length)
        offset[piece] = size - room
    return sequence, offset


def _packed(size: int) -> Callable:
    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        # The order of rows that shuffles leave is not to decide where a piece goes.
        group = group.sort_by([("length", "descending"), ("tie", "ascending"), ("piece", "ascending")])
        sequence, offset = first_fit_decreasing(group.column("length").to_numpy(), size)
        return pa.table({"piece": group.column("piece"), "group": group.column("group"), "bin": pa.array(sequence), "offset": pa.array(offset)})

    return run


def place(pieces: DataFrame, size: int, per_group: int = GROUP) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``; every column given stays.

    ``pieces`` has ``length`` of 1 to ``size``. Offsets of a sequence have no gaps from 0 on,
    and no sequence holds more than ``size``. Pieces of equal rows are placed one by one.
    The pieces are written to the shared folder once, as their numbers must not change
    between the two uses.
    """
    own = [F.col(c).alias(f"c{i}") for i, c in enumerate(pieces.columns)]
    length = f"c{pieces.columns.index('length')}"
    rows = pieces.select(*own).withColumn("tie", F.rand(20240607)).withColumn("piece", F.monotonically_increasing_id())
    rows = materialise(rows, "pieces")
    partial = rows.filter(F.col(length) < size)
    groups = max(1, round(partial.count() / per_group))
    dealt = partial.select("piece", F.col(length).cast("long").alias("length"), "tie")
    dealt = dealt.withColumn("group", F.floor(F.col("tie") * groups))
    placed = dealt.groupBy("group").applyInArrow(_packed(size), "piece long, group long, bin long, offset long")
    placed = rows.filter(F.col(length) < size).join(placed, "piece")
    numbered = placed.withColumn("sequence_id", F.col("group") * F.lit(NUMBERS) + F.col("bin"))
    # Full pieces are sequences of their own, numbered after those of all groups.
    full = rows.filter(F.col(length) == size)
    full = full.withColumn("sequence_id", F.lit(groups * NUMBERS) + F.col("piece"))
    full = full.withColumn("offset", F.lit(0).cast("long"))
    back = [F.col(f"c{i}").alias(c) for i, c in enumerate(pieces.columns)]
    return numbered.select(*back, "sequence_id", "offset").unionByName(full.select(*back, "sequence_id", "offset"))
