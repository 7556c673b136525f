import pytest
from pyspark.sql import types as T

from fleetgauge.functions.timeparts import with_times
from fleetgauge.operators.cleansing import (
    alerts,
    cast_motors,
    cleanse,
    handle_nulls,
    ingest_gate,
    require_keys,
    validate_types,
)
from fleetgauge.rules import DEFAULT_0, INTERPOLATE, REJECT, TYPE_RULES
from fleetgauge.schema import METRICS, MOTORS, READING, reading_schema
from tests.helpers import frame, reading


def test_bad_values_become_null_and_types_stay(spark):
    df = frame(
        spark, reading(time="not-a-time", DeviceId=6, sensor1=101.0, sensor3=150.0, motor2=1501.0)
    )
    out = validate_types(df)
    row = out.first()
    assert (row.time, row.DeviceId, row.sensor1, row.sensor3, row.motor2) == (
        None, None, None, 150.0, None,
    )
    assert out.schema == READING


def test_overflow_does_not_fail_the_job(spark):
    row = cast_motors(frame(spark, reading(motor1=1e12, motor2=-0.9, motor3=1799.9))).first()
    assert (row.motor1, row.motor2, row.motor3) == (None, 0, 1799)


def test_defaults_keep_the_column_type(spark):
    schema = reading_schema(T.FloatType())
    df = spark.createDataFrame([("t", 1, None, 1.0, 1.0, 1.0, 1.0, 1.0, None, "c")], schema)
    out = handle_nulls(df)
    assert out.schema["sensor1"].dataType == T.FloatType()
    assert (out.first()["sensor1"], out.first()["isFail"]) == (0.0, False)


def test_unknown_rule(spark):
    with pytest.raises(ValueError):
        handle_nulls(frame(spark, reading()), {"sensor1": "GUESS"})


def test_interpolate_rule(spark):
    df = with_times(
        frame(
            spark,
            reading(time="2024-01-01T00:00:01", sensor1=4.0),
            reading(time="2024-01-01T00:00:02", sensor1=None),
            reading(time=None, sensor1=None),
        )
    )
    out = handle_nulls(df, {"time": REJECT, "sensor1": INTERPOLATE, "motor1": DEFAULT_0})
    assert [r.sensor1 for r in out.orderBy("time").collect()] == [4.0, 4.0]


def test_gate_and_alerts_split_the_rows(spark):
    df = frame(spark, reading(), reading(time=None), reading(DeviceId=None))
    assert (require_keys(df).count(), alerts(df).count()) == (1, 2)


def test_ingest_gate_is_tighter_on_sensor3(spark):
    df = frame(
        spark, reading(sensor3=100.0), reading(sensor3=100.1), reading(motor1=None),
        reading(motor1=9999.0), reading(isFail=None),
    )
    assert [r.motor1 for r in ingest_gate(df).collect()] == [1.0, 9999.0]


def test_cleanse_leaves_no_gaps(spark):
    df = frame(
        spark,
        reading(sensor1=None, motor1=5000.0, isFail=None),
        reading(DeviceId=6),
        reading(time="not-a-time"),
    )
    rows = cleanse(cast_motors(df)).collect()
    assert len(rows) == 1
    assert all(rows[0][c] is not None for c in METRICS)
    assert (rows[0].sensor1, rows[0].motor1, rows[0].isFail) == (0.0, 0, False)


def test_rule_tables_cover_the_record():
    assert {r.column for r in TYPE_RULES} == {"time", "DeviceId", *METRICS, "isFail"}
    assert {r.column for r in TYPE_RULES if r.kind == "int"} == {"DeviceId", *MOTORS}
