"""The stages and the registered queries."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline as C
from fleetgauge.llm import queries
from tests.llm.test_jaccard_join import _brute, _family

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_keep_columns_and_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    known = {r.doc_id: r for r in docs.collect()}
    for name, stage in C.STAGES[:-1]:
        kept = stage(spark, docs, sf_dir)
        assert kept.columns == docs.columns
        rows = kept.collect()
        assert all(known[r.doc_id] == r for r in rows)
        if name == "quality_classifier":
            good = [k for k in known if labels.get(k) == 1]
            assert len({r.doc_id for r in rows}.intersection(good)) >= 0.95 * len(good)
        if name == "ngram_jaccard_join":
            texts = [(k, r.text) for k, r in sorted(known.items())]
            assert {r.doc_id for r in rows} == {k for k, _, home in _brute(texts, C.SHINGLE, C.ALIKE) if k == home}


def test_one_of_each_group_stays(spark, sf_dir):
    drawn = random.Random(12)
    texts = [t for words in (8, 60, 200) for t in _family(drawn, words, 12, max(1, words // 40))]
    rows = [(k, t, "en", f"s{k % 3}", len(t)) for k, t in enumerate(texts)]
    rows += [rows[0], rows[0], (None, texts[0], "en", "s", 1), (1000, None, None, None, None), (1001, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = [r.doc_id for r in C.ngram_jaccard_join(spark, docs, sf_dir).collect()]
    homes = {k for k, _, home in _brute([(r[0], r[1]) for r in rows if r[0] is not None and r[0] < 1000], C.SHINGLE, C.ALIKE) if k == home}
    assert sorted(map(str, kept)) == sorted(map(str, [*homes, None, 1000, 1001]))


def test_stages_at_the_edges(spark, sf_dir):
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "9 9", None, "s", 3)]
    for docs in (spark.createDataFrame([], SCHEMA), spark.createDataFrame(rows, SCHEMA)):
        for _, stage in C.STAGES:
            assert stage(spark, docs, sf_dir).count() <= len(rows)
    assert not C.language_id(spark, spark.createDataFrame(rows, SCHEMA), sf_dir).count()


def test_run(spark, sf_dir):
    rows = C.run(spark, sf_dir).collect()
    assert rows and {r.doc_id for r in rows} <= {r.doc_id for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    spans = {}
    for r in rows:
        spans.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all(sum(n for _, n in s) <= 2048 for s in spans.values())
    # The pieces of a document, put together, are its tokens and the one that ends it.
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
    for doc in sorted(pieces)[:60]:
        ids = np.array([*library.encode(texts[doc] or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(pieces[doc], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)


def test_other_columns_may_have_any_name(spark, sf_dir):
    """Names that the stages use inside come through unchanged."""
    names = ["key", "label", "score", "component_id", "shingle", "leader", "c0", "row", "piece", "sequence_id", "offset", "_place"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(80)
    more = docs.select("*", *[F.concat(F.lit(f"{n} "), F.col("doc_id").cast("string")).alias(n) for n in names])
    for _, stage in C.STAGES[:-1]:
        got = {r.doc_id: r for r in stage(spark, more, sf_dir).collect()}
        assert set(got) == {r.doc_id for r in stage(spark, docs, sf_dir).collect()}
        assert all(r[n] == f"{n} {k}" for k, r in got.items() for n in names)
    assert C.packing(spark, more, sf_dir).count() == C.packing(spark, docs, sf_dir).count()


@pytest.mark.parametrize("name", sorted(queries.oracle()))
def test_query_matches_sql(name, spark, sf_dir, duck):
    result = entry.queries()[name](spark, sf_dir)
    columns = sorted(result.columns)
    ours = sorted(repr(tuple(r[c] for c in columns)) for r in result.collect())
    reply = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in reply.description]
    assert sorted(names) == columns
    assert ours == sorted(repr(tuple(r[names.index(c)] for c in columns)) for r in reply.fetchall())


def test_all_are_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14)) and "pipeline" in entry.queries()
