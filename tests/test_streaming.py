"""Streams against the batch operators, restarts, replays, late and untimed rows."""

import glob
import json
import os

import pytest

from fleetgauge.functions.messages import parse_messages, to_messages
from fleetgauge.functions.timeparts import with_hour_key, with_times
from fleetgauge.operators.latest import latest_per_device
from fleetgauge.operators.rollup import hourly_device_mean
from fleetgauge.schema import METRICS, READING
from fleetgauge.sources.files import HOURLY_GLOB, json_stream
from fleetgauge.streaming import queries as run
from fleetgauge.streaming.transforms import (
    dedup_stream,
    hourly_mean_stream,
    latest_stream,
    route_stream,
)
from tests.helpers import frame, reading, rows_of


def land(folder, name, *rows):
    path = os.path.join(folder, "2024/01/01/00")
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, f"{name}.json"), "w") as out:
        out.writelines(json.dumps(r) + "\n" for r in rows)


def at(minute, second=0, **changes):
    time = f"2024-01-01T{minute // 60:02d}:{minute % 60:02d}:{second:02d}"
    return reading(**{"time": time, "collected_at": time, **changes})


def finish(query):
    query.awaitTermination()
    return query


@pytest.fixture
def landed(folder):
    """Four files; copies within one file and across files."""
    land(folder, "1", at(0), at(0, DeviceId=2, sensor1=None), at(0, collected_at="2024-01-01T00:00:30"))
    land(folder, "2", at(1), at(0), at(2, sensor1=500.0))
    land(folder, "3", at(3, isFail=True), at(3, time=None), at(3, time=None, DeviceId=2))
    land(folder, "4", at(70), at(3, time="not-a-time"), at(3, time="not-a-time", sensor1=2.0))
    return folder


def source(spark, landed):
    return json_stream(spark, f"{landed}/{HOURLY_GLOB}", files_per_trigger=1)


def test_routed_stream_equals_batch(spark, landed):
    out, checkpoint = f"{landed}/out", f"{landed}/checkpoint"
    finish(run.route_to_files(route_stream(source(spark, landed)), out, checkpoint, every=None))
    once = spark.read.parquet(out)
    assert {r.route: r["count"] for r in once.groupBy("route").count().collect()} == {
        "data": 3, "dataerr": 1, "fail": 1, "unrouted": 1, "reject": 4,
    }
    before = rows_of(once)
    # A restart on the same checkpoint finds nothing new and adds nothing.
    finish(run.route_to_files(route_stream(source(spark, landed)), out, checkpoint, every=None))
    assert rows_of(spark.read.parquet(out)) == before
    land(landed, "5", at(71), at(70))
    finish(run.route_to_files(route_stream(source(spark, landed)), out, checkpoint, every=None))
    assert spark.read.parquet(out).count() == len(before) + 1


def test_batch_callback_survives_a_replay(spark, folder):
    store = run.replace_batch(f"{folder}/staging", ("route",))
    batch = route_stream(frame(spark, reading(), reading(sensor1=500.0)), delay=None)
    for batch_id in (0, 0, 1):
        store(batch, batch_id)
    assert spark.read.parquet(f"{folder}/staging").count() == 4


def test_json_sink_by_device_and_hour(spark, landed):
    routed = route_stream(source(spark, landed), delay=None).filter("route = 'data'")
    layout = ("DeviceId", "ymdh")
    finish(run.to_files(routed, f"{landed}/out", f"{landed}/c", "json", layout, every=None))
    assert glob.glob(f"{landed}/out/DeviceId=1/ymdh=2024010101/*.json")


def test_late_and_future_readings_are_stored(spark, folder):
    """Half an hour late, hours late, and from a clock that says 2099: all are kept, copies are not."""
    land(folder, "1", at(60), at(60), at(61))
    land(folder, "2", reading(time="2099-01-01T00:00:00", DeviceId=9, collected_at="2099-01-01T00:00:00"))
    land(folder, "3", at(30), at(60), at(30, DeviceId=2))
    land(folder, "4", at(200), at(0, DeviceId=3))
    land(folder, "5", at(1, DeviceId=3), at(30), at(201))
    stream = json_stream(spark, f"{folder}/{HOURLY_GLOB}", files_per_trigger=1)
    finish(run.to_files(route_stream(stream), f"{folder}/out", f"{folder}/c", every=None))
    stored = spark.read.parquet(f"{folder}/out")
    sent = spark.read.schema(READING).json(f"{folder}/{HOURLY_GLOB}")
    assert stored.count() == sent.dropDuplicates(["time", "DeviceId"]).count() == 9


def test_dedup_state_is_dropped_behind_the_watermark(spark, folder):
    for name in "123":
        land(folder, name, at(int(name)), at(int(name)))
    one = json_stream(spark, f"{folder}/{HOURLY_GLOB}", files_per_trigger=1)
    stream = dedup_stream(with_times(one), "1 millisecond")
    query = finish(run.to_files(stream, f"{folder}/out", f"{folder}/c", every=None))
    assert spark.read.parquet(f"{folder}/out").count() == 3
    # Three keys were seen; what arrived longer ago than the delay is no longer held.
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] < 3


def test_untimed_rows_are_kept_in_every_batch(spark, folder):
    land(folder, "1", at(0), at(0, time=None, sensor1=1.0), at(0, time=None, sensor1=2.0))
    land(folder, "2", at(300), at(0, time=None, sensor1=3.0))
    land(folder, "3", at(600), at(0, time="not-a-time", sensor1=4.0))
    stream = route_stream(source(spark, folder))
    finish(run.to_files(stream, f"{folder}/out", f"{folder}/c", every=None))
    rejected = spark.read.parquet(f"{folder}/out").filter("route = 'reject'")
    assert sorted(r.sensor1 for r in rejected.collect()) == [1.0, 2.0, 3.0, 4.0]


def test_latest_stream_equals_batch(spark, landed):
    running = latest_stream(with_times(source(spark, landed)))
    store = run.replace_batch(f"{landed}/changes")
    finish(run.for_batches(running, store, f"{landed}/c", "update", every=None))
    changes = spark.read.parquet(f"{landed}/changes")
    batch = with_times(spark.read.schema(READING).json(f"{landed}/{HOURLY_GLOB}"))
    kept = ["DeviceId", "time", *METRICS]
    assert rows_of(latest_per_device(changes).select(*kept)) == rows_of(
        latest_per_device(batch).select(*kept)
    )


def test_hourly_stream_emits_closed_hours(spark, landed):
    land(landed, "6", at(200))
    means = hourly_mean_stream(with_times(source(spark, landed)))
    finish(run.to_files(means, f"{landed}/out", f"{landed}/c", every=None))
    batch = with_times(spark.read.schema(READING).json(f"{landed}/{HOURLY_GLOB}"))
    closed = hourly_device_mean(with_hour_key(batch)).filter("ymdh < '2024010103'")
    got = spark.read.parquet(f"{landed}/out")
    assert rows_of(got.select(*closed.columns)) == rows_of(closed)


def test_rules_stream(spark, landed):
    base = f"{landed}/rules"
    finish(run.run_rules(source(spark, landed), base, f"{landed}/c", every=None))
    assert spark.read.parquet(f"{base}/raw").count() == 10
    assert spark.read.json(f"{base}/alerts").count() == 2
    clean = spark.read.parquet(f"{base}/cleansed")
    assert clean.filter("sensor1 IS NULL OR motor1 IS NULL OR isFail IS NULL").isEmpty()
    gauges = run.current_gauges(spark.read.parquet(f"{base}/gauges"))
    values = {(r.metric, r.device_id): r.value for r in gauges.collect()}
    assert values["fms_device_online", "2"] == 1.0
    # The newest batch that saw device 1 holds one reading of 1.0.
    assert values["fms_sensor1_value", "1"] == 1.0


def test_fill_carries_over_batches_and_replays(spark, folder):
    land(folder, "1", at(0, sensor1=1.0), at(1, sensor1=None), at(0, DeviceId=2, sensor1=None))
    land(folder, "2", at(2, sensor1=None, sensor2=7.0), at(3, DeviceId=3, sensor1=3.0))
    land(folder, "3", at(4, sensor1=None, sensor2=None), at(5, DeviceId=2, sensor1=2.0))
    land(folder, "4", at(6, DeviceId=3, sensor1=None), at(6, time=None, sensor1=None))
    store = run.fill_batch(folder)
    timed = with_times(source(spark, folder))
    finish(run.for_batches(timed, store, f"{folder}/c", every=None))

    def filled():
        return spark.read.parquet(f"{folder}/filled").drop("batch_id", "event_ts", "collected_ts")

    got = {(r.time, r.DeviceId): (r.sensor1, r.sensor2) for r in filled().collect()}
    assert got == {
        (at(0)["time"], 1): (1.0, 1.0),
        (at(1)["time"], 1): (1.0, 1.0),
        (at(0)["time"], 2): (None, 1.0),
        (at(2)["time"], 1): (1.0, 7.0),
        (at(3)["time"], 3): (3.0, 1.0),
        (at(4)["time"], 1): (1.0, 7.0),
        (at(5)["time"], 2): (2.0, 1.0),
        (at(6)["time"], 3): (3.0, 1.0),
        (None, 1): (None, 1.0),
    }
    batch = with_times(frame(spark, at(6, DeviceId=3, sensor1=None), at(6, time=None, sensor1=None)))
    before = rows_of(filled())
    store(batch, 3)
    assert rows_of(filled()) == before


def test_fill_keeps_the_newest_when_batches_are_out_of_order(spark, folder):
    land(folder, "1", at(720, sensor1=50.0))
    land(folder, "2", at(660, sensor1=10.0))
    land(folder, "3", at(730, sensor1=None))
    land(folder, "4", at(700, sensor1=None))
    store = run.fill_batch(folder)
    timed = with_times(json_stream(spark, f"{folder}/{HOURLY_GLOB}", files_per_trigger=1))
    finish(run.for_batches(timed, store, f"{folder}/c", every=None))
    got = {r.time: r.sensor1 for r in spark.read.parquet(f"{folder}/filled").collect()}
    assert got[at(730)["time"]] == 50.0
    # What was newer than this gap is not carried back into it, and what was older is no longer held.
    assert got[at(700)["time"]] is None


def test_payload_with_a_line_break_lands_as_one_line(spark, folder):
    land(folder, "1", at(0))
    broken = source(spark, folder).selectExpr(
        "concat('{\\n\"DeviceId\": 1,\\r\\n \"time\": \"', time, '\"}') as value"
    )
    finish(run.land_lines(broken, f"{folder}/lines", f"{folder}/c", every=None))
    parsed = parse_messages(spark.read.text(f"{folder}/lines")).collect()
    assert [(r.DeviceId, r.malformed) for r in parsed] == [(1, False)]


@pytest.mark.parametrize("spread", [1, 4])
def test_many_copies_of_one_reading(spark, folder, spread):
    for name in "123":
        land(folder, name, *[at(0)] * 40, at(int(name)))
    stream = dedup_stream(
        with_times(json_stream(spark, f"{folder}/{HOURLY_GLOB}", files_per_trigger=2)), spread=spread
    )
    finish(run.to_files(stream, f"{folder}/out", f"{folder}/c", every=None))
    assert spark.read.parquet(f"{folder}/out").count() == 4


def test_payloads_are_archived_unparsed(spark, landed):
    sent = to_messages(source(spark, landed))
    finish(run.land_messages(sent, f"{landed}/raw", f"{landed}/c", every=None))
    lines = spark.read.schema("json string").json(f"{landed}/raw")
    assert lines.count() == 12
    assert json.loads(lines.first()["json"])["DeviceId"] in (1, 2)


def test_one_file_per_batch(spark, landed):
    query = finish(
        run.to_files(source(spark, landed), f"{landed}/out", f"{landed}/c", every=None)
    )
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 4
