"""Byte-level BPE and packing, against the libraries and by what they promise."""

import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from fleetgauge.llm import byte_bpe as B
from fleetgauge.llm import packing as K

RANKS, WORDS = P.path("byte_bpe_multi_50k.tiktoken"), P.path("word_bpe_49k.json")
SIGNS = "abc  \n\t\r .,!'sté漢字🙂  ​0１９\x1c\x85　 aaa   ' '' ZİΣ'S 'LL Ⅷ²½ﬁÄ{e}́<|endoftext|>"


def _texts():
    drawn = random.Random(9)
    made = ["".join(drawn.choice(SIGNS) for _ in range(drawn.choice([0, 1, 2, 5, 20, 200]))) for _ in range(1500)]
    return ["", " ", "  a", "a  ", "\n\n x", "word " * 40, "x" * 5000, "ab" * 3000, *made]


def test_byte_bpe_is_the_librarys(spark, sf_dir):
    vocab = B.vocabulary(RANKS)
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=vocab.ranks, special_tokens={})
    texts = _texts() + [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60).collect()]
    for encoder in (B.Encoder(vocab, P.PATTERN), B.Encoder(vocab, P.PATTERN, remembered=50)):
        for low in range(0, len(texts), 300):
            part = texts[low : low + 300]
            for text, ids in zip(part, encoder.encode(part)):
                ids = np.frombuffer(ids, "<u4")
                assert ids.tolist() == library.encode_ordinary(text), repr(text)
                assert vocab.decode(ids) == text.encode()
    for piece in (b"hello", b"unbelievable!", "日本語".encode()):
        assert B.merge_long(piece, vocab) == B.merge_short([piece], vocab)[0].tolist()


def test_byte_bpe_rows(spark):
    rows = [(1, None, b"x"), (2, "", None), (3, "a b", None), (3, "a b", None), (None, "é" * 300_000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids binary")
    got = B.decode(B.encode(df, RANKS, P.PATTERN), RANKS).collect()
    assert sorted((str(r.doc_id), bytes(r.decoded)) for r in got) == sorted((str(k), (t or "").encode()) for k, t, _ in rows)
    assert B.encode(df.limit(0), RANKS, P.PATTERN).collect() == []


def test_word_tokenizer_is_the_librarys():
    for remembered in (10_000, 40):
        own = K.WordTokenizer(WORDS, remembered)
        texts = _texts()
        for low in range(0, len(texts), 300):
            assert own.encode(texts[low : low + 300]) == own._library(texts[low : low + 300])


def _first_fit(lengths, size):
    """The plain form: every open sequence is tried in turn."""
    rooms, out = [], {}
    for piece in sorted(range(len(lengths)), key=lambda p: -lengths[p]):
        for k, room in enumerate(rooms):
            if room >= lengths[piece]:
                break
        else:
            k = len(rooms)
            rooms.append(size)
        out[piece] = (k, size - rooms[k])
        rooms[k] -= lengths[piece]
    return [out[p] for p in range(len(lengths))]


def test_tournament_is_first_fit_decreasing():
    drawn = np.random.default_rng(10)
    for count in (0, 1, 2, 300):
        lengths = drawn.integers(1, 64, count)
        sequence, offset = K.first_fit_decreasing(lengths, 64)
        assert list(zip(sequence.tolist(), offset.tolist())) == _first_fit(lengths.tolist(), 64)


@pytest.mark.parametrize("per_group", [1 << 13, 20])
def test_packing(spark, sf_dir, per_group):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source").limit(120)
    extra = spark.createDataFrame([(9001, None, ""), (9002, "", ""), (9003, "a" * 40_000, ""), (None, "b c", "")], docs.schema)
    docs = docs.unionByName(extra)
    tokens = {r.doc_id: np.frombuffer(r.ids, "<u4") for r in K.tokenize(docs, WORDS).collect()}
    whole = K.WordTokenizer(WORDS).whole
    for r in docs.collect():
        assert tokens[r.doc_id].tolist() == [*whole.encode(r.text or "", add_special_tokens=False).ids, 1]
    placed = K.place(K.cut(K.tokenize(docs, WORDS), 256), 256, per_group).collect()
    by_doc, by_sequence = {}, {}
    for r in placed:
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.length and (ids == tokens[r.doc_id][r.start : r.start + r.length]).all()
        by_doc.setdefault(r.doc_id, []).append((r.start, r.length))
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert r.doc_tokens == len(tokens[r.doc_id]) and zlib.crc32(ids.tobytes()) >= 0
    assert set(by_doc) == set(tokens)
    for spans, total in [*((s, len(tokens[d])) for d, s in by_doc.items()), *((s, None) for s in by_sequence.values())]:
        at = 0
        for start, length in sorted(spans):
            assert start == at
            at += length
        assert at == total if total is not None else at <= 256
    assert K.place(K.cut(K.tokenize(docs.limit(0), WORDS), 256), 256).collect() == []


def test_repeated_rows_are_placed_each(spark):
    docs = spark.createDataFrame([(1, "a b c", 0, 0)] * 5, "doc_id long, text string, sequence_id int, piece int")
    rows = K.place(K.cut(K.tokenize(docs, WORDS), 16), 16).collect()
    assert len(rows) == 5 and len({(r.sequence_id, r.offset) for r in rows}) == 5


def test_added_tokens_are_the_librarys():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORDS)
    texts = ["a<|endoftext|>b c", "<|startoftext|>", "<|STARTOFTEXT|> x", "plain <|endoftext |>", "\u4e2d<|endoftext|>", "no token"]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert 49407 in want[0]
    assert [np.frombuffer(ids, "<u4").tolist() for ids in K.WordTokenizer(WORDS).encode(texts)] == want
