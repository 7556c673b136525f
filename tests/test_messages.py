from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetgauge.functions.messages import (
    malformed,
    parse_messages,
    stamp_collected,
    to_messages,
    well_formed,
)
from fleetgauge.schema import READING_COLUMNS, reading_schema
from tests.helpers import frame, plan_of, reading


def parsed(spark, text, **options):
    df = spark.createDataFrame([(text,)], "value string")
    return parse_messages(df, **options)


@pytest.mark.parametrize(
    "text", ["{bad", '{"time":"2024-01-01T00:00:07","Devi', "[]", "5", "", "  ", None]
)
def test_broken_text_is_malformed(spark, text):
    df = parsed(spark, text)
    assert well_formed(df).isEmpty()
    assert malformed(df).first()["text"] == text


def test_one_wrong_field_loses_only_that_field(spark):
    row = well_formed(parsed(spark, '{"DeviceId":"x","sensor1":5}')).first()
    assert (row.DeviceId, row.sensor1) == (None, 5.0)


def test_quoted_number_is_not_a_number(spark):
    row = well_formed(parsed(spark, '{"DeviceId":1,"sensor1":"7.5"}')).first()
    assert (row.DeviceId, row.sensor1) == (1, None)


def test_empty_object_is_well_formed(spark):
    assert well_formed(parsed(spark, "{}")).count() == 1


def test_round_trip_keeps_nulls(spark):
    df = frame(spark, reading(), reading(sensor1=None, isFail=None, time=None))
    sent = to_messages(df)
    assert sent.first()["key"] == "1"
    assert '"sensor1":null' in sent.collect()[1]["value"]
    assert well_formed(parse_messages(sent)).collect() == df.collect()


def test_other_envelope_and_float_schema(spark):
    schema = reading_schema(T.FloatType(), collected_at=False)
    df = spark.createDataFrame([(bytearray(b'{"DeviceId":3,"sensor1":1.5}'),)], "data binary")
    out = well_formed(parse_messages(df, envelope="data", schema=schema))
    assert out.schema["sensor1"].dataType == T.FloatType()
    assert "collected_at" not in out.columns
    assert out.first()["DeviceId"] == 3


def test_text_is_parsed_once_under_filters(spark, folder):
    to_messages(frame(spark, reading())).write.parquet(f"{folder}/m")
    df = well_formed(parse_messages(spark.read.parquet(f"{folder}/m")))
    plan = plan_of(df.filter("isFail = false AND sensor1 > 0"))
    assert plan.count("from_json") == 1


def test_stamp_uses_the_given_clock(spark):
    clock = F.lit(datetime(2025, 7, 9, 6, 0, 3)).cast("timestamp")
    row = stamp_collected(frame(spark, reading(collected_at=None)), clock).first()
    assert row.collected_at == "2025-07-09T06:00:03.000000"
    assert set(row.asDict()) == set(READING_COLUMNS)


@pytest.mark.parametrize(
    "text, broken",
    [
        ('{"DeviceId":1}garbage', True),
        ('{"DeviceId":1}{"DeviceId":2}', True),
        ('{"DeviceId":1},{"DeviceId":2}', True),
        ('{"DeviceId":"x"}', False),
        ('{"DeviceId":1,"sensor1":"7.5"}', False),
        (' {} ', False),
        ("[1]", True),
        ("7", True),
    ],
)
def test_malformed_is_not_one_whole_object(spark, text, broken):
    df = spark.createDataFrame([(text,)], "value string")
    assert parse_messages(df).first()["malformed"] == broken
