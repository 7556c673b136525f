"""Training rows: a bounded part of the labelled ones, held-out rows left out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Every fourth document by the checksum of its id is kept for tests and never learnt from.
HELD_OUT = 2
# Places in the order that a sample is drawn by.
PLACES = 1 << 63


def held_out(key: str) -> Column:
    """Whether a document is held out; one without an id is, as nothing says it is not."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(True))


def _place(key: str) -> Column:
    """Where a key stands in an order that has nothing to do with the table's; 63 bits, so no share is too small."""
    return F.xxhash64(F.col(key).cast("string"), F.lit(7)).bitwiseAND(F.lit(PLACES - 1))


def sample_of(df: DataFrame, key: str, rows: int) -> DataFrame:
    """About ``rows`` rows, never over 1.2 times as many and all of a smaller table, chosen by a hash of their key.

    The choice does not depend on how the table is partitioned, also among the rows of one key.
    """
    most = rows + rows // 5
    share = min(1.0, rows / max(df.select(key).count(), 1))
    chosen = df.withColumn("_place", _place(key))
    if share < 1:
        chosen = chosen.filter(F.col("_place") < int(share * PLACES))
    content = F.xxhash64(*[F.col(c) for c in df.columns])
    return chosen.orderBy("_place", content).limit(most).drop("_place")


def training_rows(labelled: DataFrame, key: str, text: str, label: str, rows: int, most_chars: int) -> DataFrame:
    """At most ``rows`` rows that are not held out and have a label and a text, the same number of each label.

    A rare label has all of its rows, so that one in many thousands is learnt. Of a longer text
    ``most_chars`` characters are taken, from a place that its hash names. Of more labels than
    rows the frequent ones count.
    """
    fit = labelled.filter(~held_out(key) & F.col(label).isNotNull() & (F.octet_length(text) > 0))
    often = fit.groupBy(F.col(label).alias("_label")).agg(F.count("*").alias("_n"))
    often = often.orderBy(F.desc("_n"), "_label").limit(rows)
    labels = max(often.count(), 1)
    each = rows // labels
    # Twice as many as wanted are drawn by their place before any two rows are compared.
    drawn = fit.join(F.broadcast(often), F.col(label) == F.col("_label")).withColumn("_place", _place(key))
    drawn = drawn.filter(F.col("_place") <= F.least(F.lit(1.0), F.lit(2.0 * each + 100) / F.col("_n")) * F.lit(float(PLACES)))
    order = Window.partitionBy("_label").orderBy("_place", F.xxhash64(text))
    drawn = drawn.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= each)
    begin = F.pmod(F.xxhash64(text), F.greatest(F.length(text) - most_chars, F.lit(0)) + 1) + 1
    window = F.substring(F.col(text), begin.cast("int"), F.lit(most_chars))
    return drawn.select(F.col(key), window.alias(text), F.col(label))
