import random
import re

import numpy as np
import pyarrow as pa
import pytest

from fleetgauge.llm import jaccard_join as J
from fleetgauge.llm import words as W
from fleetgauge.llm.components import components
from fleetgauge.llm.count_tree import CountTree


def _set(text, shingle):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < shingle:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + shingle]) for k in range(len(words) - shingle + 1)}


def _brute(rows, shingle, percent):
    sets = [(k, _set(t, shingle)) for k, t in rows]
    home = {k: k for k, _ in rows}
    pairs = []
    for i, (a, x) in enumerate(sets):
        for b, y in sets[i + 1 :]:
            both = len(x & y)
            if both and 100 * both >= percent * len(x | y):
                pairs.append((a, b))
    for _ in rows:
        before = dict(home)
        for a, b in pairs:
            home[a] = home[b] = min(home[a], home[b])
        if home == before:
            break
    return {(k, len(s), home[k]) for k, s in sets}


def _family(drawn, words, copies, edits):
    base = [f"w{drawn.randrange(5000)}" for _ in range(words)]
    for _ in range(copies):
        own = list(base)
        for _ in range(drawn.randrange(edits + 1)):
            own[drawn.randrange(len(own))] = f"e{drawn.randrange(10**6)}"
        yield " ".join(own)


@pytest.mark.parametrize("shingle, percent, tile, hot", [(3, 90, 2048, 24), (3, 90, 8, 2), (5, 80, 2048, 24), (5, 80, 8, 2)])
def test_against_brute_force(spark, monkeypatch, shingle, percent, tile, hot):
    monkeypatch.setattr(J, "TILE", tile)
    monkeypatch.setattr(J, "HOT_LEAST", hot)
    drawn = random.Random(6)
    passage = " ".join(f"p{k}" for k in range(60))
    texts = ["", "one", "one two", "One  TWO", "\t\n", "a b c", "a b c d", "é É"]
    for words in (4, 12, 40, 150, 700):
        texts += _family(drawn, words, 14, max(1, words // 30))
    texts += _family(drawn, 120, 40, 4)
    texts += [passage + " " + t for t in _family(drawn, 30, 12, 30)]
    texts += texts[20:40]
    rows = [(k, t) for k, t in enumerate(drawn.sample(texts, len(texts)))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in J.near_duplicates(df, shingle=shingle, percent=percent).collect()}
    assert got == _brute(rows, shingle, percent)


def test_edge_rows(spark):
    rows = [(1, "a b c d", 0), (1, "a b c d", 0), (2, None, 0), (3, "", 0), (None, "a b c d", 0), (4, "A b  c d", None), (5, "x" * 3_000_000 + " y", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_shingles int")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in J.near_duplicates(df).collect()), key=str)
    assert got == sorted([(1, 2, 1), (1, 2, 1), (2, 0, 2), (3, 0, 3), (None, 2, None), (4, 2, 1), (5, 1, 5)], key=str)
    assert J.near_duplicates(df.limit(0)).collect() == []
    assert len(J.near_duplicates(df.filter("doc_id = 2")).collect()) == 1


def test_tree_misses_no_pair():
    drawn = np.random.default_rng(7)
    sizes = drawn.integers(20, 400, 300)
    sets = [np.sort(drawn.choice(np.arange(1, 900, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), s, replace=False)) for s in sizes]
    sets += [np.sort(drawn.choice(s, int(len(s) * 0.95), replace=False)) for s in sets[:80]]
    sizes = np.array([len(s) for s in sets])
    counts = np.array([J.group_counts(s, 64) for s in sets])
    tree = CountTree(counts, sizes)
    found = {frozenset(p) for a, b in tree.pairs(tree, 90) for p in zip(a.tolist(), b.tolist())}
    halves = np.arange(150), np.arange(150, len(sets))
    trees = [CountTree(counts[h], sizes[h]) for h in halves]
    across = {frozenset((int(halves[0][x]), int(halves[1][y]))) for a, b in trees[0].pairs(trees[1], 90) for x, y in zip(a, b)}
    for i in range(len(sets)):
        for j in range(i):
            both = J.shared(sets[i], sets[j])
            if 100 * both >= 90 * (sizes[i] + sizes[j] - both):
                assert frozenset((i, j)) in found
                assert (j < 150) == (i < 150) or frozenset((i, j)) in across


def test_words_and_shingles():
    texts = [None, "", " a", "A b\x0bc\x0c d", "x y x y x y", "é É z", "q" * 700_000 + " r"]
    hashes, bounds = W.word_hashes(*W.text_buffers(pa.array(texts, pa.string())))
    assert np.diff(bounds).tolist() == [0, 0, 1, 4, 6, 2, 2]
    values, ends = W.distinct_per_text(*W.shingle_hashes(hashes, bounds, 2))
    assert np.diff(ends).tolist() == [0, 0, 1, 3, 2, 1, 1]


def test_components(spark):
    drawn = random.Random(8)
    links = [(drawn.randrange(300), drawn.randrange(300)) for _ in range(200)] + [(1000 + k, 1001 + k) for k in range(60)]
    links += [(5, 5), (None, 3), (4, None), *links[:10]]
    home = {k: k for pair in links for k in pair if None not in pair and pair[0] != pair[1]}
    for _ in range(70):
        for a, b in links:
            if a in home and b in home and a != b and None not in (a, b):
                home[a] = home[b] = min(home[a], home[b])
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {(r.node, r.component) for r in got} == set(home.items()) and len(got) == len(home)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
