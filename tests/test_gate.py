"""The gate on raw messages: absent, null, ill-typed and out-of-range fields are told apart."""

import json

from fleetgauge.operators import gate
from tests.helpers import BASE, plan_of

ID = ("n",)


def _judged(spark, *texts, **rules):
    df = spark.createDataFrame(list(enumerate(texts)), "n int, value string")
    return gate.judge_messages(df, keep=ID, **rules)


def _report(judged):
    rows = gate.gate_report(judged, ID).collect()
    return {n: ({(r.field, r.reason) for r in rows if r.n == n}, {r.passes for r in rows if r.n == n}) for n in {r.n for r in rows}}


def _message(**changes):
    record = {**BASE, **changes}
    return json.dumps({k: v for k, v in record.items() if v is not ...})


def test_reasons(spark):
    texts = {
        _message(): (set(), True),
        _message(motor1=None): ({("motor1", "null")}, True),
        _message(motor1=...): ({("motor1", "absent")}, False),
        _message(sensor1=None): ({("sensor1", "null")}, False),
        _message(sensor2="7"): ({("sensor2", "wrong type")}, False),
        _message(sensor3=100.5): ({("sensor3", "out of range")}, False),
        _message(sensor3=True, motor2="x"): ({("sensor3", "wrong type"), ("motor2", "wrong type")}, False),
        _message(isFail="yes", time=5, DeviceId=1.5): ({("isFail", "wrong type"), ("time", "wrong type"), ("DeviceId", "wrong type")}, True),
        _message(sensor1=0, sensor2=100, sensor3=100.0, collected_at=..., extra=[1]): (set(), True),
        _message(DeviceId=...): ({("DeviceId", "absent")}, False),
    }
    found = _report(_judged(spark, *texts))
    for n, (reasons, passes) in enumerate(texts.values()):
        assert found[n] == (reasons or {(None, None)}, {passes}), list(texts)[n]


def test_broken_payloads(spark):
    found = _report(_judged(spark, "", "nope", "[1]", "7", "null", '{"a": 1', '{"time": 1, "time": 2}', None))
    assert len(found) == 8 and all(f == ({(None, "malformed")}, {False}) for f in found.values())
    ((reasons, passes),) = _report(_judged(spark, "{}")).values()
    assert {r for _, r in reasons} == {"absent"} and len(reasons) == 9 and passes == {False}


def test_strict_gate_and_passing_messages(spark):
    df = spark.createDataFrame([(0, _message(motor1=None)), (1, _message()), (2, "x")], "n int, value string")
    assert {r.n for r in gate.gate_messages(df, keep=ID).collect()} == {0, 1}
    strict = gate.gate_messages(df, keep=ID, strict=True)
    assert [(r.n, r.value) for r in strict.collect()] == [(1, _message())]
    assert gate.gate_messages(df.limit(0)).collect() == []
    counts = gate.gate_counts(gate.judge_messages(df, keep=ID))
    assert {tuple(r) for r in counts.collect()} == {("motor1", "null", 1), (None, "malformed", 1)}


def test_payload_is_parsed_once(spark):
    judged = _judged(spark, _message()).filter("passes").filter("size(failures) = 0")
    assert plan_of(judged).lower().count("parse_json") + plan_of(judged).count("parseJson") <= 2
