"""From raw documents to packed training sequences.

Each stage takes the session, the documents its predecessor kept and the tables' folder.
All but the last return the columns of documents: they keep or drop whole rows.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge.llm import jaccard_join, language, quality
from fleetgauge.llm.queries import packed
from fleetgauge.session import materialise

# A text's language must be likelier than not; texts in several languages pass.
LEAST_SURE = 0.4
# Near-duplicates share this many percent of their runs of so many words.
SHINGLE = 5
ALIKE = 80


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; texts without letters go, as do those no language suits.

    Learns from the documents it is given, so that a table without languages keeps nothing
    and an empty one stays empty.
    """
    return language.keep_identified(docs, language.train(docs), LEAST_SURE)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality network predicts to be good, learnt from the labels of those it is given."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_good(docs, quality.train(docs, labels))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id.

    Repeated rows of an id count as one document: the row that is smallest in the order of
    the columns stays. Rows without an id are linked with nothing and stay.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = {c: names[i] for i, c in enumerate(docs.columns)}
    key, rows = at["doc_id"], docs.toDF(*names)
    found = jaccard_join.near_duplicates(rows, key, at["text"], SHINGLE, ALIKE)
    found = materialise(found.filter(F.col(key).isNotNull()), "groups")
    # What goes is a small part of the rows and has ids only, so that texts need no shuffle
    # unless there is more of it than fits a broadcast.
    gone = found.filter(F.col(key) != F.col("component_id")).select(key).distinct()
    again = found.groupBy(key).count().filter("count > 1").select(key)
    few = jaccard_join.BROADCAST_IDS
    gone = materialise(gone, "gone")
    rows = rows.join(F.broadcast(gone) if gone.count() <= few else gone, key, "left_anti").select(*names)
    again = materialise(again, "again")
    many = again.count()
    if many:
        again = F.broadcast(again) if many <= few else again
        one = rows.join(again, key, "left_semi").groupBy(key).agg(F.min(F.struct(*names)).alias("row"))
        rows = rows.join(again, key, "left_anti").select(*names).unionByName(one.select("row.*"))
    return rows.toDF(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens in sequences: see ``fleetgauge.llm.packing``."""
    return packed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("quality_classifier", quality_classifier),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("packing", packing),
]

# Two stages are trained models and the last is a tokenizer: SQL cannot express them.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
