"""Quality of a text: random-indexing word vectors, pooled, through a small network.

Tokens are runs of one kind of character: small letters, capitals, digits or signs. Every
token has a sparse random index vector, drawn from its hash; its word vector is the sum
of the index vectors seen next to it in all texts, labelled or not, damped and scaled. A text is
the mean of its tokens' vectors, the mean product of neighbours' vectors, which shows
repetition and word order, and the same mean product for index vectors. A network of two
layers scores it; its temperature is set on training rows it has not seen.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetgauge.llm import words as W
from fleetgauge.llm.sampling import held_out, sample_of
from fleetgauge.llm.tiles import bound_batches, give_back

# Word vectors: their number (tokens share one by hash), their length, signs of an index vector.
WORDS = 1 << 15
WIDTH = 48
SIGNS = 4
REACH = 2
# Neighbours that a task holds before it hands their counts on, and the numbers of 16 words' neighbours.
PAIRS = 1 << 23
BLOCK = 16 << 17
# Shuffle partitions, a few times the cores, for each share of the tasks whose counts are merged first.
SHARE = 64
HIDDEN = 32
# Tokens that the mean text counts for beside a text's own.
DOUBT = 16
# The bound of the training sample: rows, and bytes of the longest text in it.
TRAINING_ROWS = 6000
TRAINING_BYTES = 20_000
GOOD = 0.7

_KIND = np.full(256, 4, dtype=np.uint8)
_KIND[0x80:] = 1
_KIND[ord("a") : ord("z") + 1] = 1
_KIND[ord("A") : ord("Z") + 1] = 2
_KIND[ord("0") : ord("9") + 1] = 3
_KIND[W.SPACES] = 0


def tokens(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of every token, and the tokens before each text's first and after its last."""
    hashes, at = W.run_hashes(data, bounds, _KIND)
    return (hashes % np.uint64(WORDS)).astype(np.int64), at


def index_vectors() -> np.ndarray:
    """SIGNS entries of 1 or -1 in each row, the same in every process."""
    drawn = np.random.default_rng(8)
    out = np.zeros((WORDS, WIDTH), dtype=np.float32)
    places = np.argsort(drawn.random((WORDS, WIDTH)), axis=1)[:, :SIGNS]
    out[np.arange(WORDS)[:, None], places] = drawn.choice(np.float32([-1, 1]), (WORDS, SIGNS))
    return out


def neighbours(words: np.ndarray, bounds: np.ndarray) -> Iterator[np.ndarray]:
    """A number for each word and each neighbour up to REACH away in its text, a portion at a time.

    Its bits: the word (15), the distance (1), the side (1), the neighbour (15).
    """
    text = np.repeat(np.arange(len(bounds) - 1, dtype=np.int32), np.diff(bounds))
    words = words.astype(np.uint32)
    for low in range(0, len(words), 1 << 18):
        for reach in range(REACH):
            right = words[low + reach + 1 : low + reach + 1 + (1 << 18)]
            left = words[low : low + len(right)]
            same = text[low + reach + 1 : low + reach + 1 + len(right)] == text[low : low + len(right)]
            left, right, far = left[same], right[same], np.uint32(reach << 16)
            yield (left << np.uint32(17)) | far | right
            yield (right << np.uint32(17)) | far | np.uint32(1 << 15) | left


def _packed(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seven bits a byte, the lowest first, and the bytes of each number."""
    sizes = np.ones(len(numbers), dtype=np.int32)
    most = int(numbers.max(initial=0)).bit_length()
    for bits in range(7, most, 7):
        sizes += numbers >= 1 << bits
    first = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), dtype=np.uint8)
    for k in range(-(-most // 7) or 1):
        own = np.flatnonzero(sizes > k)
        more = (sizes[own] > k + 1).astype(np.uint8) << np.uint8(7)
        out[first[own] + k] = ((numbers[own] >> (7 * k)) & 127).astype(np.uint8) | more
    return out, sizes


def _unpacked(data: np.ndarray) -> np.ndarray:
    last = np.flatnonzero(data < 128)
    first = np.concatenate([[0], last[:-1] + 1])
    out = np.zeros(len(last), dtype=np.int64)
    for k in range(int((last - first).max(initial=0)) + 1):
        own = np.flatnonzero(first + k <= last)
        out[own] |= (data[first[own] + k] & 127).astype(np.int64) << (7 * k)
    return out


def _rows(numbers: np.ndarray, often: np.ndarray) -> pa.RecordBatch:
    """A row for each block of words met: gaps between its neighbours' ascending numbers, and how often the repeated ones come."""
    begins = np.flatnonzero(np.diff(numbers // BLOCK, prepend=-1))
    blocks = numbers[begins] // BLOCK
    gaps = np.diff(numbers, prepend=0)
    gaps[begins] = numbers[begins] % BLOCK
    columns = [pa.array(blocks)]
    for values, heads in (
        ((gaps << 1) | (often > 1), begins),
        (often[often > 1], np.searchsorted(np.flatnonzero(often > 1), begins)),
    ):
        data, sizes = _packed(values)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        bounds = np.append(ends[heads], len(data)).astype(np.int32)
        columns.append(pa.Array.from_buffers(pa.binary(), len(blocks), [None, pa.py_buffer(bounds), pa.py_buffer(data)]))
    return pa.RecordBatch.from_arrays(columns, names=["block", "gaps", "repeats"])


def _read(gaps: bytes, repeats: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Numbers inside a block, ascending, and how often each comes."""
    gaps = _unpacked(np.frombuffer(gaps, np.uint8))
    often = 1 + (gaps & 1)
    often[often > 1] = _unpacked(np.frombuffer(repeats, np.uint8)) if repeats else 0
    return np.cumsum(gaps >> 1), often


def _blocks(numbers: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Counts of the numbers, which are sorted in place and written out a portion at a time.

    A number at the edge of two portions has a row in both: counts add up.
    """
    numbers.sort()
    for low in range(0, len(numbers), 1 << 19):
        part = numbers[low : low + (1 << 19)]
        first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        yield _rows(part[first].astype(np.int64), np.diff(first, append=len(part)))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of neighbours in a task's texts, PAIRS at a time, from one buffer of that size."""
    held, full = np.empty(PAIRS, dtype=np.uint32), 0
    for batch in batches:
        texts = batch.column(0)
        for low, high in W.slices(texts, 1 << 20):
            for part in neighbours(*tokens(*W.text_buffers(texts.slice(low, high - low)))):
                while len(part):
                    own, part = part[: PAIRS - full], part[PAIRS - full :]
                    held[full : full + len(own)] = own
                    full += len(own)
                    if full == PAIRS:
                        yield from _blocks(held)
                        full = 0
    yield from _blocks(held[:full])
    del held
    give_back()


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for all rows of a block and a share of the tasks, which follow each other.

    Holds the counts of one block, at most BLOCK, and as many that are still to be added.
    """
    now, numbers, often, waiting = None, [], [], 0

    def add_up() -> None:
        nonlocal waiting
        waiting = 0
        at, counts = np.concatenate(numbers), np.concatenate(often)
        order = np.argsort(at, kind="stable")
        at = at[order]
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        numbers[:], often[:] = [at[first]], [np.add.reduceat(counts[order], first)]

    def finished() -> pa.RecordBatch:
        add_up()
        out = _rows(numbers[0] + now[0] * BLOCK, often[0])
        numbers.clear()
        often.clear()
        return out

    for batch in batches:
        for *key, gaps, repeats in zip(*[column.to_pylist() for column in batch.columns]):
            if now not in (None, key):
                yield finished()
            now = key
            at, counts = _read(gaps, repeats)
            numbers.append(at)
            often.append(counts)
            waiting += len(at)
            if waiting > BLOCK >> 1:
                add_up()
    if now is not None:
        yield finished()


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the index vectors beside each word, from all rows of its block, which follow each other."""
    index = _index()
    places = np.nonzero(index)[1].reshape(WORDS, SIGNS)
    signs = np.take_along_axis(index, places, axis=1).astype(np.float64)
    counts = np.zeros(BLOCK, dtype=np.int64)
    inside = BLOCK >> 17

    def finished(block: int) -> pa.RecordBatch:
        sums, met = np.zeros(inside * WIDTH), np.flatnonzero(counts)
        for low in range(0, len(met), 1 << 16):
            part = met[low : low + (1 << 16)]
            mate, weight = part % WORDS, np.log1p(counts[part])[:, None]
            at = (part >> 17)[:, None] * WIDTH + places[mate]
            sums += np.bincount(at.ravel(), (signs[mate] * weight).ravel(), inside * WIDTH)
        words = np.unique(met >> 17)
        counts[:] = 0
        rows = [row.tobytes() for row in sums.reshape(inside, WIDTH)[words]]
        return pa.RecordBatch.from_arrays([pa.array(block * inside + words), pa.array(rows, pa.binary())], names=["word", "sums"])

    now = None
    for batch in batches:
        columns = [batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()]
        for block, gaps, repeats in zip(*columns):
            if now not in (None, block):
                yield finished(now)
            now = block
            at, often = _read(gaps, repeats)
            counts[at] += often
    if now is not None:
        yield finished(now)


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Sums of the neighbours' index vectors over all texts, damped, of length 1.

    Labels play no part, so every row counts, whole. A pair of words weighs the logarithm of
    one more than its number in the table. Words not met have their index vector. A task sums
    a block of words, so the sums do not depend on how the table is partitioned; at most
    WORDS rows of them come to the driver.
    """
    bound_batches(docs.sparkSession)
    texts = docs.select(F.col(text).cast("string").alias("text"))
    counted = texts.mapInArrow(_counted, "block long, gaps binary, repeats binary")
    # Tasks by the thousand have a row each of a block: shares of them are merged before a block meets.
    shares = -(-int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) // SHARE)
    if shares > 1:
        counted = counted.withColumn("share", F.pmod(F.spark_partition_id(), F.lit(shares)))
        counted = counted.select("block", "share", "gaps", "repeats").repartition("block", "share")
        counted = counted.sortWithinPartitions("block", "share").mapInArrow(_merged, "block long, gaps binary, repeats binary")
    # A task reads all rows of a block one after another and holds the counts of that block.
    sums = counted.repartition("block").sortWithinPartitions("block").mapInArrow(_summed, "word long, sums binary")
    found = sums.toArrow()
    table = np.zeros((WORDS, WIDTH))
    for batch in found.to_batches(max_chunksize=1 << 12):
        table[batch["word"].to_numpy()] = np.frombuffer(b"".join(batch["sums"].to_pylist())).reshape(-1, WIDTH)
    del found
    sizes = np.linalg.norm(table, axis=1, keepdims=True)
    return np.where(sizes > 1e-9, table / np.maximum(sizes, 1e-9), _index() / np.sqrt(SIGNS)).astype(np.float32)


def pooled(words: np.ndarray, bounds: np.ndarray, vectors: np.ndarray, index: np.ndarray) -> np.ndarray:
    """Mean vectors and mean products of neighbours' vectors of each text; zeros without tokens."""
    out = np.zeros((len(bounds) - 1, 3 * WIDTH), dtype=np.float32)
    for row, (low, high) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
        if low == high:
            continue
        total = np.zeros(3 * WIDTH)
        # Portions overlap by the token whose product the next one begins with.
        for start in range(low, high, 1 << 15):
            part = words[max(low, start - 1) : min(high, start + (1 << 15))]
            own, raw = vectors[part], index[part]
            total[:WIDTH] += own[start > low :].sum(axis=0)
            total[WIDTH : 2 * WIDTH] += np.einsum("ij,ij->j", own[1:], own[:-1])
            total[2 * WIDTH :] += np.einsum("ij,ij->j", raw[1:], raw[:-1])
        total[:WIDTH] /= high - low
        total[WIDTH:] /= max(high - low - 1, 1)
        out[row] = total
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class QualityModel:
    vectors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]
    temperature: float

    @classmethod
    def fit(cls, texts: Sequence[str] | pa.ChunkedArray, labels: Sequence[int], vectors: np.ndarray, rounds: int = 60) -> QualityModel:
        column = texts if isinstance(texts, pa.ChunkedArray) else pa.array(texts, pa.string())
        x, sizes = np.zeros((len(column), 3 * WIDTH), dtype=np.float32), np.zeros(len(column), dtype=np.int64)
        for low, high in W.slices(column, 1 << 20) if len(column) else ():
            words, bounds = tokens(*W.text_buffers(column.slice(low, high - low)))
            x[low:high], sizes[low:high] = pooled(words, bounds, vectors, _index()), np.diff(bounds)
        y = np.asarray(labels, dtype=np.float32)
        mean, scale = (x.mean(axis=0), x.std(axis=0) + 1e-6) if len(x) else (np.zeros(3 * WIDTH), np.ones(3 * WIDTH))
        model = cls(vectors, mean.astype(np.float32), scale.astype(np.float32), [], 1.0)
        if len(set(y.tolist())) < 2:
            # Nothing to tell apart: everything scores as the only label does, or as good.
            model.layers = [np.zeros((3 * WIDTH, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), np.array([4.0 * (2 * y[0] - 1) if len(y) else 4.0])]
            return model
        check = np.arange(len(x)) % 5 == 0
        x = model._inputs(x, sizes)
        model._train(x, y, check, rounds)
        model._calibrate(x[check], y[check])
        return model

    def _inputs(self, x: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """Distances from the mean text, in deviations; the fewer tokens, the nearer to it."""
        return (x - self.mean) / self.scale * (tokens / (tokens + DOUBT))[:, None].astype(np.float32)

    def _train(self, x, y, check, rounds) -> None:
        drawn = np.random.default_rng(80)
        inputs = x.shape[1]
        layers = [
            drawn.normal(0, np.sqrt(1 / inputs), (inputs, HIDDEN)).astype(np.float32),
            np.zeros(HIDDEN, dtype=np.float32),
            drawn.normal(0, np.sqrt(1 / HIDDEN), HIDDEN).astype(np.float32),
            np.zeros(1, dtype=np.float32),
        ]
        first, second = [np.zeros_like(p) for p in layers], [np.zeros_like(p) for p in layers]
        rows = np.flatnonzero(~check)
        best, step = (np.inf, layers), 0
        for _ in range(rounds):
            drawn.shuffle(rows)
            for low in range(0, len(rows), 64):
                part = rows[low : low + 64]
                step += 1
                for k, g in enumerate(_gradients(layers, x[part], y[part])):
                    g = g + 1e-3 * layers[k] * (layers[k].ndim > 1)
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    move = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                    layers[k] = (layers[k] - 2e-3 * move).astype(np.float32)
            loss = _loss(_logits(layers, x[check]), y[check])
            if loss < best[0]:
                best = loss, [p.copy() for p in layers]
        self.layers = best[1]

    def _calibrate(self, x, y) -> None:
        """The temperature with the least loss on rows the layers were not fitted to."""
        logits = _logits(self.layers, x)
        tried = np.geomspace(0.5, 8, 61)
        self.temperature = float(tried[np.argmin([_loss(logits / t, y) for t in tried])])

    def score(self, texts: pa.Array) -> np.ndarray:
        words, bounds = tokens(*W.text_buffers(texts))
        x = pooled(words, bounds, self.vectors, _index())
        return _sigmoid(_logits(self.layers, self._inputs(x, np.diff(bounds))) / self.temperature)


_kept: dict = {}


def _index() -> np.ndarray:
    if "index" not in _kept:
        _kept["index"] = index_vectors()
    return _kept["index"]


def _logits(layers, x):
    return np.tanh(x @ layers[0] + layers[1]) @ layers[2] + layers[3]


def _loss(logits, y):
    return float(np.mean(np.logaddexp(0, logits) - y * logits))


def _gradients(layers, x, y):
    hidden = np.tanh(x @ layers[0] + layers[1])
    off = (_sigmoid(hidden @ layers[2] + layers[3]) - y) / len(y)
    back = off[:, None] * layers[2] * (1 - hidden * hidden)
    return x.T @ back, back.sum(axis=0), hidden.T @ off, off.sum(keepdims=True)


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> QualityModel:
    """Word vectors from all rows; the network from at most 1.2 TRAINING_ROWS labelled ones not held out.

    Labels of a key that has both count as rows of their own; null ones are left out.
    """
    marked = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")).filter("label in (0, 1)")
    chosen = sample_of(marked.filter(~held_out("key")).distinct(), "key", TRAINING_ROWS)
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    rows = rows.filter(F.octet_length("text").between(1, TRAINING_BYTES))
    # The chosen labels are at most 1.2 TRAINING_ROWS, so the texts need no shuffle.
    # An id may be repeated: which of its rows are taken goes by their content.
    rows = rows.join(F.broadcast(chosen), "key").orderBy(F.xxhash64("key"), F.xxhash64("text", "label")).limit(2 * TRAINING_ROWS)
    sample = rows.toArrow().sort_by([(c, "ascending") for c in ("key", "text", "label")])
    model = QualityModel.fit(sample["text"], sample["label"].to_numpy(), word_vectors(docs, text))
    give_back()
    return model


def scores(model: QualityModel, texts: pa.Array):
    """(low, high, score) of a column, a portion of rows at a time."""
    for low, high in W.slices(texts, 1 << 20):
        yield low, high, model.score(texts.slice(low, high - low)).astype(np.float64)
    give_back()


def _scored(model: QualityModel, names: list[str]) -> Callable:
    def run(batches):
        for batch in batches:
            for low, high, score in scores(model, batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), pa.array(score)], names=names)

    return run


def assess(docs: DataFrame, model: QualityModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``score`` (0 to 1, higher is better) and ``predicted`` (1 from GOOD on) of every row.

    From the whole text alone; null and empty texts are scored as texts without tokens.
    One row for each row, repeated ones included; other columns are not read.
    """
    bound_batches(docs.sparkSession)
    schema = T.StructType([T.StructField("key", docs.schema[key].dataType), T.StructField("score", T.DoubleType())])
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    rows = rows.mapInArrow(_scored(model, schema.names), schema)
    return rows.select(F.col("key").alias(key), "score", (F.col("score") >= GOOD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: QualityModel, text: str = "text") -> DataFrame:
    """Rows, whole, with a score of GOOD or more.

    Null and empty texts are scored as texts without tokens. Repeated rows are judged alike, an
    empty table stays empty, and no other column is looked at, whatever its name.
    """
    bound_batches(docs.sparkSession)
    at = docs.columns.index(text)

    def run(batches):
        for batch in batches:
            keep = [score >= GOOD for _, _, score in scores(model, batch.column(at).cast(pa.string()))]
            if keep:
                yield batch.filter(pa.array(np.concatenate(keep)))

    renamed = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return renamed.mapInArrow(run, renamed.schema).toDF(*docs.columns)
