"""How results leave a query, so that every client reads them alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge.schema import READING_COLUMNS

ROW = ("event_id", *READING_COLUMNS)
SECONDS, MICROS = "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm:ss.SSSSSS"


def shown(column: str, pattern: str = MICROS) -> Column:
    """Timestamps leave a query as text, whatever the reader's zone."""
    return F.date_format(column, pattern).alias(column)


def text(*columns: str) -> list[Column]:
    """Whole numbers and booleans that may be NULL leave as text: clients differ on them."""
    return [F.col(c).cast("string").alias(c) for c in columns]


def rows(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in ROW if c != "isFail"], *text("isFail"))


def rounded(*columns: str) -> list[Column]:
    """Four decimals; what a float sum leaves of a tie counts as a tie and goes up."""
    return [(F.floor(F.col(c) * 10000.0 + 0.500001) / 10000.0).alias(c) for c in columns]
