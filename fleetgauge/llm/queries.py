"""Registered queries of the operators: each applies one to a whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge.llm import (
    best_fit,
    byte_bpe,
    fingerprints,
    jaccard_join,
    language,
    licences,
    main_text,
    packing,
    periodic_runs,
    prefix_trie,
    quality,
    quotations,
    vector_graph,
)
from fleetgauge.llm.sampling import held_out
from fleetgauge.session import materialise

SEQUENCE = 2048


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_edits(_table(spark, sf_dir, "documents"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(_table(spark, sf_dir, "pages"))


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_graph.near_duplicates(_table(spark, sf_dir, "embeddings"), least=0.9)


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, percent=90)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = language.identify(docs, language.train(docs))
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op6_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotations.reply_order(_table(spark, sf_dir, "conversations"))


def op7_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(_table(spark, sf_dir, "documents"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = quality.assess(docs, quality.train(docs, _table(spark, sf_dir, "labels")))
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")


def op9_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ids = byte_bpe.encode(_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    return byte_bpe.decode(ids, path).select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(_table(spark, sf_dir, "documents"))


def packed(docs: DataFrame) -> DataFrame:
    """Pieces of the documents' tokens in sequences, with the checksum of each piece's ids in their place."""
    tokens = packing.tokenize(docs, public_tokenizers.path("word_bpe_49k.json"), end=1)
    pieces = packing.cut(tokens, SEQUENCE)
    pieces = pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return packing.place(pieces, SEQUENCE)


def with_shared_heads(numbered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like the first of their twenty, and all their ids.

    Conversation c has the first h turns of c - c % 20, then its own after its first h; h is
    the checksum of its id modulo 4.
    """
    heads = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    sizes = numbered.groupBy("conv_id").agg(F.max("depth").alias("n"))
    sizes = sizes.select("conv_id", "n", heads.alias("h"), (F.col("conv_id") - F.col("conv_id") % 20).alias("base"))
    bases = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("there"))
    sizes = sizes.join(bases, "base", "left")
    sizes = materialise(sizes.withColumn("taken", F.least("h", F.coalesce("there", F.lit(0)))), "sizes")
    first = numbered.filter("conv_id % 20 = 0 and depth <= 3").withColumnRenamed("conv_id", "base")
    first = first.join(sizes.filter("taken > 0").select("base", "conv_id", "taken"), "base").filter("depth <= taken")
    # A long conversation's size is sent to its turns in so many rows that none is joined to all.
    stretch = F.explode(F.sequence(F.lit(0).cast("long"), F.expr("n div 65536"))).alias("stretch")
    moved = sizes.select("conv_id", "h", (F.col("taken") - F.col("h")).alias("by"), stretch)
    rest = numbered.withColumn("stretch", F.expr("depth div 65536")).join(moved, ["conv_id", "stretch"])
    rest = rest.filter("depth > h").withColumn("depth", F.col("depth") + F.col("by"))
    columns = ["conv_id", "depth", "role", "text"]
    return rest.select(*columns).unionByName(first.select(*columns)), sizes.select("conv_id")


def op11_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, members = with_shared_heads(prefix_trie.number(_table(spark, sf_dir, "conversations")))
    return prefix_trie.prefix_trie(turns, members).withColumnRenamed("parent", "parent_conv_id")


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = best_fit.tokenize(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end=0)
    pieces = best_fit.cut(tokens, SEQUENCE)
    pieces = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return best_fit.place(pieces, SEQUENCE)


def repeated_in_part(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``; every tenth document by the checksum of its id repeats some of its words to the end."""
    checksum = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(1))
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), checksum.alias("h"))
    some = F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    rows = rows.select("doc_id", "text", F.expr("h div 10").alias("g"), F.filter(some, lambda w: w != "").alias("w"))
    rows = rows.withColumn("n", F.size("w")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    rows = rows.withColumn("p", (1 + F.expr("(n - a) div (3 + g % 8)")).cast("int"))
    again = F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), F.expr("int((n - a + p - 1) div p)")))
    words = F.concat(F.slice("w", F.lit(1), F.col("a")), F.slice(again, F.lit(1), F.col("n") - F.col("a")))
    return rows.select("doc_id", F.when(F.col("n") > 0, F.array_join(words, " ")).otherwise(F.col("text")).alias("text"))


def op13_periodic_run_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(repeated_in_part(_table(spark, sf_dir, "documents")))
    found = found.withColumn("best", periodic_runs.strongest("runs"))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


QUERIES: tuple[Callable[[SparkSession, str], DataFrame], ...] = (
    op1_document_fingerprints,
    op2_html_extraction,
    op3_embedding_near_dedup,
    op4_ngram_jaccard_join,
    op5_language_id,
    op6_quotation_linking,
    op7_license_scans,
    op8_quality_classifier,
    op9_byte_level_bpe,
    op10_packing,
    op11_conversation_prefix_trie,
    op12_best_fit_packing,
    op13_periodic_run_detection,
)


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in QUERIES}


NGRAM_JACCARD_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), grams AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(generate_series(1, len(w) - 2), lambda k: w[k] || ' ' || w[k + 1] || ' ' || w[k + 2])) END AS g
  FROM words
), sized AS (SELECT doc_id, CAST(len(g) AS BIGINT) AS n FROM grams),
gram AS (SELECT doc_id, unnest(g) AS s FROM grams),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM gram a JOIN gram b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), link AS (
  SELECT a, b FROM shared JOIN sized x ON x.doc_id = a JOIN sized y ON y.doc_id = b WHERE 100 * common >= 90 * (x.n + y.n - common)
), arrow AS (SELECT a AS u, b AS v FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT u, v FROM arrow UNION SELECT r.u, e.v FROM reach r JOIN arrow e ON r.v = e.u)
SELECT s.doc_id, n AS n_shingles, least(s.doc_id, coalesce(min(v), s.doc_id)) AS component_id
FROM sized s LEFT JOIN reach ON u = s.doc_id GROUP BY s.doc_id, n
"""

EMBEDDING_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), arrow AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM v a JOIN v b ON a.vec_id <> b.vec_id
    AND list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e) * list_dot_product(b.e, b.e)) >= 0.9
), reach AS (SELECT u, v FROM arrow UNION SELECT r.u, e.v FROM reach r JOIN arrow e ON r.v = e.u),
home AS (SELECT vec_id, least(vec_id, coalesce((SELECT min(v) FROM reach WHERE u = vec_id), vec_id)) AS component_id FROM embeddings)
SELECT vec_id, (SELECT count(*) FROM arrow WHERE u = vec_id) AS n_links, component_id, vec_id = component_id AS kept FROM home
"""


PREFIX_TRIE_SQL = r"""
WITH ids AS (SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL),
heads AS (
  SELECT c, c - c % 20 AS base, CAST(xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(c AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))),
    lambda crc, s: list_reduce(list_prepend(xor(crc, s), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])), lambda v, i: xor(v >> 1, (v & 1) * 3988292384)))) % 4 AS BIGINT) AS h
  FROM ids
), numbered AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS d
  FROM conversations WHERE conv_id IS NOT NULL
), taken AS (
  SELECT c, base, h, least(h, (SELECT count(*) FROM numbered n WHERE n.c = base)) AS got FROM heads
), built AS (
  SELECT t.c, n.d, n.role, n.text FROM taken t JOIN numbered n ON n.c = t.base AND n.d <= t.got
  UNION ALL SELECT t.c, n.d - t.h + t.got, n.role, n.text FROM taken t JOIN numbered n ON n.c = t.c AND n.d > t.h
), path AS (
  SELECT c, d, md5(string_agg(md5(role) || md5(text), ',') OVER (PARTITION BY c ORDER BY d ROWS UNBOUNDED PRECEDING)) AS k,
    len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS w FROM built
  UNION ALL SELECT c, 0, '', 0 FROM ids
), node AS (
  SELECT d, k, min(c) AS conv_id, count(*) AS n, any_value(w) AS w FROM path GROUP BY d, k
), edge AS (
  SELECT n.d, n.k, u.k AS up FROM node n JOIN path u ON u.c = n.conv_id AND u.d = n.d - 1
), kids AS (SELECT d - 1 AS d, up AS k, count(*) AS kids FROM edge GROUP BY ALL),
own AS (SELECT n.*, coalesce(kids, 0) AS kids FROM node n LEFT JOIN kids USING (d, k)),
below AS (
  SELECT p.d, p.k, sum(CASE WHEN o.kids = 0 THEN 1 ELSE 0 END) AS leaves, sum((o.n - 1) * o.w) AS saved
  FROM own o JOIN path p ON p.c = o.conv_id AND p.d <= o.d GROUP BY p.d, p.k
), ends AS (
  SELECT d, k, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS e FROM path p WHERE d = (SELECT max(d) FROM path q WHERE q.c = p.c) GROUP BY d, k
)
SELECT o.conv_id, CAST(o.d AS BIGINT) AS depth, u.conv_id AS parent_conv_id, o.n AS n_convs, CAST(o.kids AS BIGINT) AS n_children,
  CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(e, '')) AS ends_sha256
FROM own o JOIN below USING (d, k) LEFT JOIN ends USING (d, k) LEFT JOIN edge g ON g.d = o.d AND g.k = o.k LEFT JOIN node u ON u.d = o.d - 1 AND u.k = g.up
"""


def oracle() -> dict[str, str]:
    return {
        "op3_embedding_near_dedup": EMBEDDING_SQL,
        "op4_ngram_jaccard_join": NGRAM_JACCARD_SQL,
        "op6_quotation_linking": quotations.REPLY_ORDER_SQL,
        "op11_conversation_prefix_trie": PREFIX_TRIE_SQL,
    }
