"""Range rules that hold for a time, as a table, and readings judged by those of their day.

A rule names a column, inclusive bounds, and from when until when it holds; an end that
is not given is open. The rules' turns cut time into stretches in which nothing changes;
each stretch is one row with the bounds of all columns, so a reading meets one row
however many rules there are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetgauge.rules import Range

RULES = "column string, low double, high double, valid_from timestamp, valid_to timestamp"


def rule_table(spark: SparkSession, ranges: Sequence[Range], valid_from=None, valid_to=None) -> DataFrame:
    """A declared rule set as rows of the table; times are text or datetimes."""
    rows = [(r.column, float(r.low), float(r.high)) for r in ranges]
    table = spark.createDataFrame(rows, "column string, low double, high double")
    ends = {"valid_from": valid_from, "valid_to": valid_to}
    return table.withColumns({c: F.lit(v).cast("timestamp") for c, v in ends.items()})


def versions(rules: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``since``, ``until`` and ``<column>_low``, ``<column>_high`` for each stretch of time.

    Where rules of one column overlap, the one that began last holds, and of two that began
    together the tighter. A column without a rule in a stretch has no bounds there.
    """
    start = F.col("valid_from")
    turns = rules.select(F.explode(F.array("valid_from", "valid_to")).alias("since")).filter("since is not null")
    first = rules.sparkSession.range(1).select(F.lit(None).cast("timestamp").alias("since"))
    turns = turns.unionByName(first).distinct()
    # Few rows: as many as rules have turns.
    ordered = Window.orderBy(F.col("since").asc_nulls_first())
    stretches = turns.withColumn("until", F.lead("since").over(ordered))
    # A stretch lies inside a rule or beside it.
    begun = F.coalesce(start <= F.col("since"), start.isNull())
    going = F.coalesce(F.col("until") <= F.col("valid_to"), F.col("valid_to").isNull())
    own = stretches.join(rules, begun & going, "left")
    newest = F.struct(F.coalesce(F.unix_micros("valid_from"), F.lit(-(1 << 62))), -(F.col("high") - F.col("low")), "low", "high")
    best = own.groupBy("since", "until", "column").agg(F.max(newest).alias("rule"))
    bounds = [
        F.max(F.when(F.col("column") == c, F.col(f"rule.{end}"))).alias(f"{c}_{end}") for c in columns for end in ("low", "high")
    ]
    return best.groupBy("since", "until").agg(*bounds)


def _valid(columns: Sequence[str], flags: Sequence[str]) -> Column:
    """True, false, or NULL where a missing value leaves it open; no bounds are no objection."""
    valid = F.lit(True)
    for c in columns:
        within = F.col(c).between(F.col(f"_{c}_low"), F.col(f"_{c}_high"))
        valid = valid & F.when(F.col(f"_{c}_low").isNull(), F.lit(True)).otherwise(within)
    for c in flags:
        valid = valid & F.col(c).isin(True, False)
    return valid


def judge_as_of(
    df: DataFrame,
    rules: DataFrame,
    columns: Sequence[str],
    moment: str = "event_ts",
    flags: Sequence[str] = ("isFail",),
) -> DataFrame:
    """Add ``valid``, by the rules that held at each reading's time; NULL for one without a time.

    An interval join in one pass: a stretch is sent to each of the days between the first and
    the last reading that it touches, and a reading looks at the stretches of its own day only. Both
    sides meet on the day; the stretches are as many as rules change, so adaptive execution
    broadcasts them by their real size, and the readings stay where they are.
    """
    names = [f"_r{i}" for i in range(len(df.columns))]
    own = dict(zip(df.columns, names))
    rows = df.toDF(*names).withColumn("_day", F.to_date(own[moment]))
    span = rows.agg(F.struct(F.min("_day").alias("low"), F.max("_day").alias("high")).alias("span"))
    days = span.scalar()
    turns = versions(rules, columns).withColumn("_days", days)
    begins = F.greatest(F.to_date("since"), F.col("_days.low"))
    ends = F.least(F.to_date("until"), F.col("_days.high"))
    turns = turns.filter(begins <= ends).select(
        F.explode(F.sequence(begins, ends)).alias("_on"), "since", "until",
        *[f"{c}_{end}" for c in columns for end in ("low", "high")],
    )
    at = F.col(own[moment])
    here = (F.col("_day") == F.col("_on")) & F.coalesce(F.col("since") <= at, F.lit(True)) & F.coalesce(at < F.col("until"), F.lit(True))
    joined = rows.join(turns, here, "left")
    bounds = [F.col(f"{c}_{end}").alias(f"_{c}_{end}") for c in columns for end in ("low", "high")]
    judged = joined.select(*[F.col(own[c]).alias(c) for c in df.columns], *bounds)
    valid = F.when(F.col(moment).isNotNull(), _valid(columns, flags))
    return judged.withColumn("valid", valid).select(*df.columns, "valid")
