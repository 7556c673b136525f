"""The collector's gate on raw messages, before their fields get columns.

Parsed into columns, a field that is null and one that is not there look alike. Here the
payload stays a VARIANT, which keeps them apart, and every check is told with its reason.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge.rules import FIELD_KINDS, INGEST_RANGES, INGEST_REQUIRED, Range

ABSENT, NULL, WRONG_TYPE, OUT_OF_RANGE = "absent", "null", "wrong type", "out of range"
MALFORMED = "malformed"
# How VARIANT names the types that a kind of field may have.
_TYPES = {
    "text": r"^STRING$",
    "number": r"^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$",
    "whole": r"^(BIGINT|DECIMAL\(\d+,0\))$",
    "flag": r"^BOOLEAN$",
}


# What VARIANT calls the type of a JSON null.
_VOID = "VOID"


def _kind(field: str) -> Column:
    """The type of a field's value; NULL for a field that is not there."""
    return F.schema_of_variant(F.try_variant_get("payload", f"$.{field}", "variant"))


def _reason(field: str, rules: dict[str, Range]) -> Column:
    """The first check that a field fails, NULL if it passes them all; from its kind and number, which are bound."""
    kind = F.col(f"found.{field}_kind")
    reason = (
        F.when(kind.isNull(), F.lit(ABSENT))
        .when(kind == _VOID, F.lit(NULL))
        .when(~kind.rlike(_TYPES[FIELD_KINDS[field]]), F.lit(WRONG_TYPE))
    )
    if field in rules:
        within = F.col(f"found.{field}_number").between(rules[field].low, rules[field].high)
        reason = reason.when(~F.coalesce(within, F.lit(False)), F.lit(OUT_OF_RANGE))
    return reason


def judge_messages(
    df: DataFrame,
    envelope: str = "value",
    keep: Sequence[str] = (),
    required: Sequence[str] = INGEST_REQUIRED,
    ranges: Sequence[Range] = INGEST_RANGES,
    strict: bool = False,
) -> DataFrame:
    """Each message with ``text``, ``passes`` and ``failures`` (field, reason, blocks).

    A message passes as it does at the collector: every required field is there, whatever
    its value, and every ranged one is a number in its range. A null or ill-typed field
    without a range is told and does not block, unless the gate is ``strict``. Text that
    is no JSON object, or names a field twice, fails as a whole, with no field.

    The payload, and what is looked at in it, come out of generators, so that it is parsed and each
    field is looked up once, whatever is asked of them above.
    """
    rules = {r.column: r for r in ranges}
    payload = F.try_parse_json(F.col("text"))
    parsed = df.select(*keep, F.col(envelope).cast("string").alias("text")).select(
        *keep, "text", F.explode(F.array(payload)).alias("payload")
    )
    # Anything but an object has no fields at all; an empty one has none either.
    whole = F.coalesce(F.trim("text").startswith("{") & F.col("payload").isNotNull(), F.lit(False))
    looked = [_kind(field).alias(f"{field}_kind") for field in required]
    looked += [F.try_variant_get("payload", f"$.{field}", "double").alias(f"{field}_number") for field in rules if field in required]
    parsed = parsed.select(*keep, "text", F.explode(F.array(F.struct(whole.alias("whole"), *looked))).alias("found"))
    each = []
    for field in required:
        reason = _reason(field, rules)
        blocks = (reason == ABSENT) if field not in rules and not strict else reason.isNotNull()
        each.append(F.struct(F.lit(field).alias("field"), reason.alias("reason"), blocks.alias("blocks")))
    broken = F.array(
        F.struct(F.lit(None).cast("string").alias("field"), F.lit(MALFORMED).alias("reason"), F.lit(True).alias("blocks"))
    )
    failures = F.when(F.col("found.whole"), F.filter(F.array(*each), lambda f: f["reason"].isNotNull())).otherwise(broken)
    judged = parsed.select(*keep, "text", F.explode(F.array(failures)).alias("failures"))
    return judged.select(
        *keep, "text", (~F.exists("failures", lambda f: f["blocks"])).alias("passes"), "failures"
    )


def gate_messages(df: DataFrame, envelope: str = "value", keep: Sequence[str] = (), **rules) -> DataFrame:
    """The messages that pass, their payload in ``envelope`` again."""
    judged = judge_messages(df, envelope, keep, **rules).filter("passes")
    return judged.select(*keep, F.col("text").alias(envelope))


def gate_report(judged: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """A row for each failed check; a message without one has a single row without a field."""
    rows = judged.select(*keep, "passes", F.explode_outer("failures").alias("failure"))
    return rows.select(*keep, "passes", "failure.field", "failure.reason")


def gate_counts(judged: DataFrame) -> DataFrame:
    """Messages by field and reason: what a gate's alert is raised on."""
    rows = gate_report(judged).filter("reason is not null")
    return rows.groupBy("field", "reason").agg(F.count("*").alias("messages"))
