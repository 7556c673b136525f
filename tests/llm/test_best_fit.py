"""Best-fit packing, against the library, a plain form, and by what it promises."""

import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import regex
from tokenizers import Tokenizer

from fleetgauge.llm import best_fit as B
from fleetgauge.llm.queries import op12_best_fit_packing

PATH = P.path("byte_bpe_50k.json")
SIGNS = "abc  \n\t\r .,!'sté漢字🙂\xa0 ​0１９\x1c\x85　 aaa   ' '' ZİΣ'S 'LL Ⅷ²½ªºµ×÷ÄË{e}́<|endoftext|>"
LATIN = "ab  \n\t\r\x0b.'''''strevmlldSé²½ªµ×÷ß\x800 9 "


def _texts():
    drawn = random.Random(9)
    made = [
        "".join(drawn.choice(signs) for _ in range(drawn.choice([0, 1, 2, 5, 20, 200])))
        for signs in (SIGNS, LATIN, LATIN)
        for _ in range(1200)
    ]
    fixed = ["", " ", "  a", "a  ", "\n\n x", "it's 's'll 'll''ve'", "I'm we're\n'd 'd", "word " * 40, "x" * 5000, "ab" * 3000, "a<|endoftext|>b"]
    return fixed + made


def test_pieces_are_the_patterns():
    pattern = regex.compile(P.PATTERN)
    texts = [t for t in _texts() if t.isascii() or (all(ord(c) < 256 for c in t) and not set(t) & set("\x1c\x85\xa0"))]
    texts = [t for t in texts if not set(t) & set("\x1c\x1d\x1e\x1f")]
    data, bounds = B.W.text_buffers(B.pa.array(texts))
    cuts = B.pieces(data, bounds)
    got = [bytes(data[a:b]).decode() for a, b in zip(cuts[:-1], cuts[1:])]
    assert got == [piece for text in texts for piece in pattern.findall(text)] and len(texts) > 2000


@pytest.mark.parametrize("remembered", [100_000, 40])
def test_tokens_are_the_librarys(spark, sf_dir, remembered):
    own, library = B.ByteTokenizer(PATH, remembered), Tokenizer.from_file(PATH)
    texts = _texts() + [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60).collect()]
    for low in range(0, len(texts), 300):
        part = texts[low : low + 300]
        want = [e.ids for e in library.encode_batch(part, add_special_tokens=False)]
        assert [np.frombuffer(ids, "<u4").tolist() for ids in own.encode(part)] == want


class _Plain:
    """Every open bin is tried in turn."""

    def __init__(self, size, most):
        self.size, self.most, self.open, self.made = size, most, {}, 0

    def place(self, length):
        fits = [(room, -k) for k, room in self.open.items() if room >= length]
        if fits:
            room, k = min(fits)
            k = -k
        else:
            room, k = self.size, self.made
            self.made += 1
        self.open[k] = room - length
        if not self.open[k]:
            del self.open[k]
        while len(self.open) > self.most:
            fullest = min(self.open.values())
            del self.open[next(b for b in reversed(self.open) if self.open[b] == fullest)]
        return room


@pytest.mark.parametrize("most", [1, 3, 50, 1000])
def test_bitset_finds_the_tightest(most):
    drawn = np.random.default_rng(12)
    for high in (9, 64):
        bins, plain = B.OpenBins(64, most), _Plain(64, most)
        fill = {}
        for length in drawn.integers(1, high + 1, 600).tolist():
            chosen, offset = bins.place(length)
            # Which of equally full bins is taken may differ, their room may not.
            assert offset == 64 - plain.place(length) == fill.get(chosen, 0)
            fill[chosen] = offset + length
            assert fill[chosen] <= 64 and bins.open <= most
        assert bins.made == plain.made


def test_packing(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source").limit(120)
    extra = spark.createDataFrame([(9001, None, ""), (9002, "", ""), (9003, "a b" * 40_000, ""), (None, "b c", "")], docs.schema)
    docs = docs.unionByName(extra).withColumnRenamed("source", "sequence_id")
    library = Tokenizer.from_file(PATH)
    tokens = {r.doc_id: [*library.encode(r.text or "", add_special_tokens=False).ids, 0] for r in docs.collect()}
    placed = B.place(B.cut(B.tokenize(docs, PATH), 256), 256).collect()
    by_doc, by_sequence = {}, {}
    for r in placed:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert ids == tokens[r.doc_id][r.start : r.start + r.length] and len(ids) == r.length
        by_doc.setdefault(r.doc_id, []).append((r.piece, r.start, r.length))
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(by_doc) == set(tokens)
    for doc, found in by_doc.items():
        at = 0
        for number, (piece, start, length) in enumerate(sorted(found)):
            assert (piece, start) == (number, at) and (length == 256 or piece == 0)
            at += length
        assert at == len(tokens[doc])
    for found in by_sequence.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= 256
    least = -(-sum(map(len, tokens.values())) // 256)
    assert len(by_sequence) <= 1.1 * least + 1
    assert B.place(B.cut(B.tokenize(docs.limit(0), PATH), 256), 256).collect() == []


def test_repeated_rows_are_placed_each(spark):
    docs = spark.createDataFrame([(1, "a b c", 0, 0)] * 500, "doc_id long, text string, offset int, piece int")
    rows = B.place(B.cut(B.tokenize(docs, PATH), 16), 16).collect()
    assert len(rows) == 500 and len({(r.sequence_id, r.offset) for r in rows}) == 500
    assert len({r.sequence_id for r in rows}) == 125


def test_query(spark, sf_dir):
    library = Tokenizer.from_file(PATH)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op12_best_fit_packing(spark, sf_dir)
    assert rows.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    rows = rows.collect()
    for r in rows[::7]:
        ids = np.array([*library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 0], "<u4")
        assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
    total = sum(r.length for r in rows)
    assert {r.doc_id for r in rows} == set(texts) and len({r.sequence_id for r in rows}) <= 1.03 * total / 2048 + 1
