"""Periodic runs against a plain search over all periods."""

import hashlib
import re
import zlib

import numpy as np
import pytest

from fleetgauge.llm import periodic_runs as R
from fleetgauge.llm.queries import op13_periodic_run_detection, repeated_in_part


def _plain(words, least=24, times=3):
    spans = {}
    for q in range(1, len(words) // times + 1):
        same = [a == b for a, b in zip(words, words[q:])] + [False]
        start = 0
        for i, equal in enumerate(same):
            if not equal:
                if i - start and i - start + q >= max(least, times * q):
                    spans.setdefault((start, i + q), q)
                start = i + 1
    return sorted((s, e - s, q) for (s, e), q in spans.items())


def _of_texts(texts):
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    numbers = np.unique(np.concatenate([np.array(t, dtype=np.int64) for t in texts]), return_inverse=True)[1] + 1
    found = R.runs_of(numbers, bounds)
    return [found.get(k, []) for k in range(len(texts))]


def _made(drawn):
    """Runs with noise before, between and after; periods with periods in them."""
    out = []
    for _ in range(drawn.integers(1, 4)):
        letters = int(drawn.choice([1, 2, 3, 50]))
        out += drawn.integers(0, letters, drawn.integers(0, 20)).tolist()
        period = drawn.integers(0, letters, drawn.integers(1, int(drawn.choice([2, 9, 70])))).tolist()
        if drawn.random() < 0.6:
            inner = drawn.integers(0, 3, drawn.integers(1, 5)).tolist()
            period += inner * int(drawn.integers(1, 12))
        if drawn.random() < 0.3:
            period = (period * 3 + drawn.integers(0, 3, 2).tolist())[:120]
        size = int(len(period) * drawn.uniform(0.5, 7))
        out += (period * 8)[:size]
    return out


@pytest.mark.parametrize("seed", range(8))
def test_runs_are_those_of_all_periods(seed):
    drawn = np.random.default_rng(seed)
    texts = [_made(drawn) for _ in range(120)] + [[], [1], [5] * 23, [5] * 24, [5] * 700, [1, 2] * 300, drawn.integers(0, 2, 600).tolist()]
    got = _of_texts(texts)
    for text, runs in zip(texts, got):
        assert runs == _plain(text), text
    assert sum(map(len, got)) > 50


def test_wavelet_finds_successors():
    drawn = np.random.default_rng(13)
    for size in (1, 2, 63, 64, 65, 500):
        numbers = drawn.permutation(size)
        tree = R.Wavelet(numbers)
        low = drawn.integers(0, size, 200)
        high = np.minimum(low + drawn.integers(0, size + 1, 200), size)
        bound = drawn.integers(0, size + 2, 200)
        want = [min((x for x in numbers[a:b] if x >= v), default=size) for a, b, v in zip(low, high, bound)]
        assert tree.successor(low, high, bound).tolist() == want


def test_suffix_array():
    drawn = np.random.default_rng(14)
    words = np.concatenate([np.append(drawn.integers(1, 3, n), 0) for n in (0, 1, 40, 300)])
    bounds = np.array([0, 1, 3, 44, 345])
    array, _ = R.suffixes(words, bounds)
    for a, b in zip(bounds, bounds[1:]):
        assert array[a:b].tolist() == sorted(range(a, b), key=lambda i: words[i:b].tolist())


def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def _edited(doc_id, text):
    words = _words(text)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def _expected(doc_id, text):
    words = _edited(doc_id, text)
    runs = _plain(words)
    dropped = set()
    for s, n, q in runs:
        dropped.update(range(s + q, s + n))
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        doc_id,
        len(runs),
        *(best or (None,) * 3),
        best and 1000 * best[1] // best[2],
        sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
        sha(" ".join(w for i, w in enumerate(words) if i not in dropped)),
    )


def test_query(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = {r.doc_id: tuple(r) for r in op13_periodic_run_detection(spark, sf_dir).collect()}
    assert set(got) == set(docs)
    short = [k for k, text in docs.items() if len(text or "") < 8000]
    assert len(short) > 100 and sum(got[k][1] > 0 for k in short) > 5
    for k in short:
        assert got[k] == _expected(k, docs[k])


def test_edges(spark, tmp_path):
    many = " ".join(f"w{k % 7}" for k in range(100_000))
    tens = [k for k in range(200) if zlib.crc32(str(k).encode()) % 10 == 0][:6]
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "a\x0bB\x0cb " * 40), (4, "a\x0bB\x0cb " * 40), (None, "x " * 30), (5, "Ünïcode\xa0word  x " * 12)]
    rows += list(zip(tens, ["", None, "one", "a b c d e f g h " * 9, " ".join(map(str, range(400))), " \x0b "]))
    df = spark.createDataFrame([(*r, 1, "y") for r in rows], "doc_id long, text string, runs int, n_words string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, op13_periodic_run_detection(spark, str(tmp_path)).collect()), key=repr)
    assert got == sorted((_expected(*r) for r in rows), key=repr)
    found = R.find_runs(spark.createDataFrame([(9, many)], "doc_id long, text string")).first()
    assert [tuple(r) for r in found.runs] == [(0, 100_000, 7)] and found.collapsed == " ".join(f"w{k}" for k in range(7))
    assert R.find_runs(df.limit(0)).collect() == []
    assert [" ".join(_edited(r.doc_id, r.text)) for r in df.collect()] == [" ".join(_words(r.text)) for r in repeated_in_part(df).collect()]
