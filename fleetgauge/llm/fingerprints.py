"""SimHash fingerprints of texts, and all of them within a Hamming radius.

A text's terms are its runs of two words. Each distinct term votes on every bit of the
fingerprint, for or against by the bits of its hash, with a weight of one more than the
logarithm of how often the text has it. Texts that share terms agree in bits: the share
of bits that differ is the angle between their weighted term vectors over pi.

For the search the bits are cut into blocks. Two fingerprints that differ in at most
``radius`` bits agree in all but ``radius`` blocks, so a table for each choice of the
other blocks, keyed by their bits, brings all of them together; the rest is compared bit
by bit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetgauge.llm import words as W

BITS = 128
TERM_WORDS = 2
BLOCKS = 8
RADIUS = 6
# Rows that follow each other in order and are handed on together.
STRETCH = 1024
MOST_STRETCHES = 1 << 16

# The signs of the eight bits of every byte, the first bit first.
_SIGNS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.float64) * 2 - 1


def fingerprints(texts: pa.Array) -> np.ndarray:
    """BITS bits, packed in bytes, for each text; all zero for one without words."""
    out = np.zeros((len(texts), BITS // 8), dtype=np.uint8)
    for low, high in W.slices(texts, 1 << 20):
        hashes, at = W.word_hashes(*W.text_buffers(texts.slice(low, high - low)))
        terms, often, bounds = W.counted_per_text(*W.shingle_hashes(hashes, at, TERM_WORDS))
        weight = 1 + np.log(often)
        both = np.stack([terms, W.mix(terms ^ np.uint64(0xA0761D6478BD642F))], axis=1)
        places = both.view(np.uint8).reshape(len(terms), BITS // 8) + np.arange(BITS // 8) * 256
        for row, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
            if a == b:
                continue
            # Terms with the same byte at a place vote alike on its eight bits.
            sums = np.bincount(places[a:b].ravel(), np.repeat(weight[a:b], BITS // 8), BITS // 8 * 256)
            votes = sums.reshape(BITS // 8, 256) @ _SIGNS
            out[low + row] = np.packbits(votes > 0, axis=1)[:, 0]
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of the angle that the differing bits stand for, from 0 (unlike) to 1 (equal)."""
    differ = np.unpackbits(a ^ b, axis=1).sum(axis=1)
    return np.maximum(0.0, np.cos(np.pi * differ / BITS))


def _fingerprinted(names: list[str]) -> Callable:
    def run(batches):
        for batch in batches:
            found = fingerprints(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f.tobytes().hex() for f in found], pa.string())], names=names)

    return run


def fingerprint(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``fingerprint``, BITS bits in hexadecimal digits, of every row's whole text.

    Equal texts have equal fingerprints; null, empty and wordless ones have only zeros. One
    row for each row, repeated ones included; columns other than ``key`` and ``text`` are
    not read.
    """
    schema = T.StructType([T.StructField("key", docs.schema[key].dataType), T.StructField("fingerprint", T.StringType())])
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    rows = rows.mapInArrow(_fingerprinted(schema.names), schema)
    return rows.select(F.col("key").alias(key), "fingerprint")


def differing_bits(a: str | Column, b: str | Column) -> Column:
    """Hamming distance of two fingerprints."""
    digits = BITS // 4
    half = [F.conv(F.substring(F.col(c) if isinstance(c, str) else c, s, 16), 16, -10).cast("long") for c in (a, b) for s in range(1, digits, 16)]
    words = digits // 16
    return sum((F.bit_count(half[k].bitwiseXOR(half[words + k])) for k in range(1, words)), F.bit_count(half[0].bitwiseXOR(half[words])))


def block_tables(fingerprint: str = "fingerprint", radius: int = RADIUS, blocks: int = BLOCKS) -> Column:
    """Keys of a fingerprint in every permuted table: the table's number and its blocks' bits."""
    digits = BITS // 4 // blocks
    cut = [F.substring(fingerprint, 1 + k * digits, digits) for k in range(blocks)]
    tables = combinations(range(blocks), blocks - radius)
    return F.array(*[F.concat(F.lit(f"{n}:"), *[cut[k] for k in table]) for n, table in enumerate(tables)])


def within_radius(
    queries: DataFrame, known: DataFrame, key: str = "doc_id", fingerprint: str = "fingerprint", radius: int = RADIUS
) -> DataFrame:
    """``query``, ``near`` and ``distance``: fingerprints of ``known`` with ``radius`` bits or fewer unlike a query's.

    ``query`` and ``near`` are fingerprints: rows with equal ones are looked up once, and
    are found again by joining. A query's own fingerprint is near it with distance 0.
    Nulls are near nothing. ``radius`` must be below BLOCKS.
    """
    tables = block_tables("f", radius)
    left = queries.select(F.col(fingerprint).alias("f")).filter("f is not null").distinct()
    right = known.select(F.col(fingerprint).alias("f")).filter("f is not null").distinct()
    left = left.select(F.col("f").alias("query"), F.explode(tables).alias("block"))
    right = right.select(F.col("f").alias("near"), F.explode(tables).alias("block"))
    pairs = left.join(right, "block").select("query", "near", differing_bits("query", "near").alias("distance"))
    return pairs.filter(F.col("distance") <= radius).distinct()


def _stretches(starts: np.ndarray, names: list[str]) -> Callable:
    """Rows with their fingerprint and stretch; the first of a stretch also closes the one before."""

    def run(batches):
        for batch in batches:
            at = batch.column(1).to_numpy()
            home = np.searchsorted(starts, at, side="right") - 1
            first = np.flatnonzero(starts[home] == at)
            rows = np.concatenate([np.arange(len(at)), first])
            stretch = np.concatenate([home, (home[first] - 1) % len(starts)])
            closing = np.arange(len(rows)) >= len(at)
            marks = pa.array([f.tobytes() for f in fingerprints(batch.column(2))], pa.binary())
            data = pa.RecordBatch.from_arrays([*batch.columns, marks], names=[*batch.schema.names, "mark"]).take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([*data.columns, pa.array(stretch, pa.int64()), pa.array(closing)], names=names)

    return run


def _with_next(batches: Iterator[pa.RecordBatch], size: int = 256) -> Iterator[tuple[list, list]]:
    """Rows of the sorted stream, each with the one after it in its stretch."""
    rows, following, last = [], [], None
    for batch in batches:
        for low in range(0, batch.num_rows, size):
            for row in batch.slice(low, size).to_pylist():
                if last is not None and not last["closing"] and last["stretch"] == row["stretch"]:
                    rows.append(last)
                    following.append(row)
                last = row
            if rows:
                yield rows, following
                rows, following = [], []


def edited_text(text: str, following: str) -> str:
    """``text`` with its last half replaced by as many characters from the start of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compared(names: list[str]) -> Callable:
    def run(batches):
        for rows, following in _with_next(batches):
            texts = [r["text"] or "" for r in rows]
            edited = [edited_text(t, n["text"] or "") for t, n in zip(texts, following)]
            own = np.frombuffer(b"".join(r["mark"] for r in rows), np.uint8).reshape(len(rows), -1)
            after = np.frombuffer(b"".join(n["mark"] for n in following), np.uint8).reshape(len(rows), -1)
            changed = fingerprints(pa.array(edited, pa.string()))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r["key"] for r in rows]),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]),
                    pa.array([f.tobytes().hex() for f in own]),
                    pa.array([f.tobytes().hex() for f in changed]),
                    pa.array(likeness(own, changed)),
                    pa.array(likeness(own, after)),
                ],
                names=names,
            )

    return run


def compare_edits(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row's fingerprint beside that of its edited text and of the next row.

    The edited text is ``edited_text`` of the row's and the next row's text, in ascending
    order of the integer ``key``; the row after the last is the first. Rows without a key
    come first; rows with the same key follow each other by fingerprint. A null text is
    empty. Columns: ``key``, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited``, ``near_next``.

    The order is cut into stretches at quantiles of the key, and the first row of each is
    also sent to the end of the one before, so no task sees more than a stream of rows.
    """
    kind = docs.schema[key].dataType
    order = F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63)))
    rows = docs.select(F.col(key).alias("key"), order.alias("at"), F.col(text).cast("string").alias("text"))
    least, count = rows.agg(F.min("at"), F.count("*")).first()
    parts = int(min(max(count // STRETCH, 1), MOST_STRETCHES))
    shares = [k / parts for k in range(1, parts)]
    cuts = rows.agg(F.percentile_approx("at", shares, max(10_000, 20 * parts))).first()[0] if shares else []
    starts = np.unique(np.array([least or 0, *cuts], dtype=np.int64))
    schema = T.StructType(
        [*rows.schema.fields, *T.StructType.fromDDL("mark binary, stretch long, closing boolean").fields]
    )
    rows = rows.mapInArrow(_stretches(starts, schema.names), schema).repartition("stretch")
    rows = rows.sortWithinPartitions("stretch", "closing", "at", "mark", "text")
    fields = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    result = T.StructType([T.StructField("key", kind), *T.StructType.fromDDL(fields).fields])
    return rows.mapInArrow(_compared(result.names), result).withColumnRenamed("key", key)
