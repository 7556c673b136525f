"""Language, quality and licences: held-out accuracy and rows at the edges."""

import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest

from fleetgauge.llm import language as L
from fleetgauge.llm import licences as N
from fleetgauge.llm import quality as Q
from fleetgauge.llm import sampling as S
from fleetgauge.llm import words as W
from fleetgauge.llm.licence_texts import NO_TERMS, NOTICES
from fleetgauge.llm.queries import op5_language_id, op8_quality_classifier

SF = "/root/testdata/sf0.01"
EDGES = [(1, None), (2, ""), (3, "12 + 3 = 15 !?"), (4, "x" * 2_000_000), (5, "the cat and the dog"), (5, "the cat and the dog"), (None, "ein Haus")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_language_of_held_out(spark, docs):
    rows = op5_language_id(spark, SF).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert np.mean([r.lang_pred == r.lang for r in rows]) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_edges(spark, docs):
    model = L.train(docs)
    df = spark.createDataFrame(EDGES, "doc_id long, text string").selectExpr("*", "'x' as lang_pred", "1 as score")
    got = {r.doc_id: r for r in L.identify(df, model).collect()}
    assert L.identify(df, model).count() == 7
    assert all((got[k].lang_pred, got[k].score) == ("und", 0) for k in (1, 2, 3)) and got[5].lang_pred != "und"
    assert L.identify(df.limit(0), model).collect() == []
    nothing = L.train(docs.limit(0))
    assert {r.lang_pred for r in L.identify(df, nothing).collect()} == {"und"}
    assert L.keep_identified(df, nothing, 0.4).collect() == []
    assert L.keep_identified(df, model, 0.0).columns == df.columns


def test_a_rare_language_is_learnt(spark):
    """One row in 5,000, and that a long one."""
    drawn = np.random.default_rng(5)
    words = {"en": "the of and to in is was for that with".split(), "de": "der die und das ist nicht ein mit auf von".split()}
    rare = " ".join(drawn.choice("och att det som en pa ar av for med".split(), 30_000))
    ids = [k for k in range(20_000) if zlib.crc32(str(k).encode()) % 4 != 2]
    rows = [(k, " ".join(drawn.choice(words[lang], 12)), lang) for k in ids[:9998] for lang in [("en", "de")[k % 2]]]
    rows += [(ids[9998], rare, "sv"), (ids[9999], rare[::-1], "xx"), (ids[9999], None, "yy"), (ids[9999], "", "zz")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = L.train(df)
    test = spark.createDataFrame([(1, rare[:200]), (2, "der die das und"), (3, "that was the")], "doc_id long, text string")
    assert {r.doc_id: r.lang_pred for r in L.identify(test, model).collect()} == {1: "sv", 2: "de", 3: "en"}
    sample = S.training_rows(df, "doc_id", "text", "lang", 3000, 20_000).toPandas()
    assert len(sample) == 1502 and sample["text"].str.len().max() == 20_000
    again = S.training_rows(df.repartition(7), "doc_id", "text", "lang", 3000, 20_000).toPandas()
    assert sorted(sample.itertuples(index=False)) == sorted(again.itertuples(index=False))


def test_samples_of_very_large_tables(spark, monkeypatch):
    """A share far below one in a million still draws rows, and as many as it should."""
    assert int(1e-12 * S.PLACES) > 9_000_000
    df = spark.range(50_000).withColumnRenamed("id", "doc_id")
    first = [r.doc_id for r in S.sample_of(df, "doc_id", 500).collect()]
    assert 400 < len(first) <= 600 and sorted(first) == sorted(r.doc_id for r in S.sample_of(df.repartition(5), "doc_id", 500).collect())
    repeated = spark.createDataFrame([(1, k) for k in range(3000)], "doc_id long, v long")
    one = sorted(r.v for r in S.sample_of(repeated, "doc_id", 3000).collect())
    assert one == list(range(3000)) and S.sample_of(repeated.limit(0), "doc_id", 5).collect() == []


def test_language_rounds():
    texts = [t * 12 for t in ("der die das und ist ", "the of and is to ", "le la les et est ", "el los las y es ", "i gatti sono qui ")]
    labels = ["de", "en", "fr", "es", "it"]
    model = L.LanguageModel.fit(texts * 8, labels * 8)
    assert sorted(model.families.classes) == ["germanic", "romance"] and len(model.languages["romance"].pairs) == 3
    import pyarrow as pa

    assert model.predict(pa.array(texts))[0].tolist() == labels


def test_quality_of_held_out(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = op8_quality_classifier(spark, SF).join(labels, "doc_id").filter("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.9
    assert all((r.predicted == 1) == (r.score >= 0.7) for r in rows)


def test_quality_edges(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = Q.train(docs, labels)
    df = spark.createDataFrame(EDGES, "doc_id long, text string").selectExpr("*", "0 as predicted")
    got = Q.assess(df, model).collect()
    assert len(got) == 7 and all(0 <= r.score <= 1 for r in got)
    assert Q.assess(df.limit(0), model).collect() == []
    assert Q.keep_good(df, model).columns == df.columns
    for empty in (Q.train(docs.limit(0), labels), Q.train(docs, labels.limit(0)), Q.train(docs, labels.filter("quality = 1"))):
        assert {r.predicted for r in Q.assess(df, empty).collect()} == {1}


def test_word_vectors_count_every_text(spark):
    rows = [(1, "the cat and the dog"), (2, "zyx wug " * 6000 + "quux"), (3, None), (4, ""), (5, "the cat sat"), (6, "one")]
    sums = np.zeros((Q.WORDS, Q.WIDTH))
    index, often = Q.index_vectors(), {}
    for _, text in rows:
        words = Q.tokens(*Q.W.text_buffers(Q.pa.array([text], Q.pa.string())))[0].tolist()
        for reach in (1, 2):
            for pair in zip(words, words[reach:]):
                often[reach, pair] = often.get((reach, pair), 0) + 1
    for (_, (a, b)), n in often.items():
        sums[a] += index[b] * np.log1p(n)
        sums[b] += index[a] * np.log1p(n)
    sizes = np.linalg.norm(sums, axis=1, keepdims=True)
    want = np.where(sizes > 0, sums / np.maximum(sizes, 1e-9), index / 2)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert np.abs(Q.word_vectors(df) - want).max() < 1e-3
    assert np.abs(Q.word_vectors(df.repartition(3)) - want).max() < 1e-3
    # Counts merged in shares of the tasks first, from buffers that fill up in the middle of a text.
    spark.conf.set("spark.sql.shuffle.partitions", str(3 * Q.SHARE))
    try:
        assert np.abs(Q.word_vectors(df.repartition(5)) - want).max() < 1e-3
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    # A long text without a label is met by the model too.
    labels = spark.createDataFrame([(1, 1), (5, 0)], "doc_id long, quality int")
    zyx = Q.tokens(*Q.W.text_buffers(Q.pa.array(["zyx"])))[0][0]
    assert np.abs(Q.train(df, labels).vectors[zyx] - want[zyx]).max() < 1e-3
    assert np.abs(want[zyx] - index[zyx] / 2).max() > 0.1


def test_counts_survive_packing_and_merging(monkeypatch):
    monkeypatch.setattr(Q, "PAIRS", 1000)
    texts = [" ".join(np.random.default_rng(k).choice(["a", "bb", "ccc", "d", "e"], 900)) for k in range(3)]
    column = Q.pa.array(texts)
    want = np.unique(np.concatenate(list(Q.neighbours(*Q.tokens(*Q.W.text_buffers(column))))), return_counts=True)
    rows = [row for batch in Q._counted([Q.pa.RecordBatch.from_arrays([column], names=["text"])]) for row in batch.to_pylist()]
    assert len(rows) > len({r["block"] for r in rows})
    rows = sorted(({"block": r["block"], "share": 0, **r} for r in rows), key=lambda r: r["block"])
    merged = [row for batch in Q._merged([Q.pa.RecordBatch.from_pylist(rows)]) for row in batch.to_pylist()]
    assert [r["block"] for r in merged] == sorted({r["block"] for r in rows})
    got = [(r["block"] * Q.BLOCK + at, often) for r in merged for at, often in [Q._read(r["gaps"], r["repeats"])]]
    assert np.array_equal(np.concatenate([g[0] for g in got]), want[0])
    assert np.array_equal(np.concatenate([g[1] for g in got]), want[1])
    large = np.array([1, 1 << 40, 127, 128, (1 << 62) - 1])
    assert np.array_equal(Q._unpacked(Q._packed(large)[0]), large)


def test_licence_notices():
    model = N.trained()
    for family, notices in NOTICES.items():
        right = [f == family for f, _, _ in model.judge([N.tokens(t) for t in notices])]
        assert sum(right) >= len(right) - 1, family
    assert [f for f, _, _ in model.judge([N.tokens(t) for t in NO_TERMS])].count("none") >= len(NO_TERMS) - 1
    assert model.judge([N.tokens("Licensed under the Zebra License 3")])[0][0] == "unknown"


def test_licence_in_long_line_and_edges(spark):
    words = " ".join(f"w{k}x" for k in range(150))
    text = f"first\n{words} Licensed under the Apache License, Version 2.0. {words}\nRéleased ünder"
    rows = [(k, t, "x") for k, t in [*EDGES, (6, text), (6, text)]]
    df = spark.createDataFrame(rows, "doc_id long, text string, family string")
    got = N.scan(df).collect()
    assert [(r.doc_id, r.paragraph, r.family) for r in got] == [(6, 1, "apache")] * 2
    assert all("Apache License" in r.notice and text[r.start : r.end] == r.notice for r in got)
    assert N.scan(df.limit(0)).collect() == []


def test_every_notice_of_a_line_is_found():
    model = N.trained()
    notice, filler = "Licensed under the Apache License, Version 2.0.", " ".join(["the river ran past the old mill and the garden"] * 40)
    text = " ".join([notice, filler, notice, filler, notice])
    found = [f for f in N.findings(text, model) if f[3] == "apache"]
    spans = [k for k in range(len(text)) if text.startswith(notice[:-1], k)]
    assert len(spans) == 3 == len(found)
    assert all(any(s <= k and k + len(notice) - 1 <= e for _, s, e, *_ in found) for k in spans)


@pytest.mark.parametrize(
    "text, families",
    [
        ("Released under MIT.", {"mit"}),
        ("SPDX-License-Identifier: MIT", {"mit"}),
        ("SPDX-License-Identifier: Apache-2.0", {"apache"}),
        ("Licensed under the MIT License or the Apache License, Version 2.0, at your option.", {"mit", "apache"}),
        ("Das Haus mit dem Garten und der Hund mit der Katze", set()),
        ("Er kam mit und lief mit ihr durch die Stadt, mit Mut und mit Kraft", set()),
        ("MIT", set()),
    ],
)
def test_names_and_several_licences(spark, text, families):
    filler = " ".join(["the river ran past the old mill and the garden"] * 4)
    df = spark.createDataFrame([(1, text), (2, f"{filler}\n{text}\n{filler}")], "doc_id long, text string")
    got = N.scan(df).collect()
    for doc in (1, 2):
        assert {r.family for r in got if r.doc_id == doc} == families


def test_every_window_and_family_without_a_prefilter(spark):
    """What the anchors pass over holds no licence, on whole tables."""
    model = N.trained()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    got = {}
    for r in N.scan(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect():
        got.setdefault(r.doc_id, set()).add((r.paragraph, r.family))
    passed = 0
    for doc, text in texts.items():
        want = set()
        for number, line in enumerate(text.split("\n")):
            words = N.tokens(line)
            windows = [words[low : low + N.WINDOW] for low in range(0, max(len(words) - N.WINDOW // 2, 1), N.WINDOW // 2)]
            for window, every in zip(windows, model.judge_all(windows)):
                want |= {(number, family) for family, *_ in every if family != N.NONE}
                passed += not any(w in model.anchors for w in window)
        assert got.get(doc, set()) == want
    assert got and passed > 1000


def test_language_training_holds_the_sample_once():
    """Whole rows of features are made for the machine being fitted alone, not for the sample and each family again."""
    drawn = np.random.default_rng(3)
    letters = {"de": "enristadhulcgm", "sv": "aentrsildomkgv"}
    texts = ["".join(drawn.choice(list(letters[lang] + "  "), 300)) for lang in letters for _ in range(200)]
    labels = [lang for lang in letters for _ in range(200)]
    rows = L.Sample.of(*W.text_buffers(pa.array(texts)))
    assert (rows.matrix(np.ones(len(texts), dtype=bool)) == L.features(*W.text_buffers(pa.array(texts)))).all()
    del rows
    tracemalloc.start()
    model = L.LanguageModel.fit(texts, labels)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 1.5 * len(texts) * L.FEATURES * 4
    found, _ = model.predict(pa.array(texts))
    assert np.mean(found == np.array(labels)) > 0.95
