import time
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from fleetgauge.functions.timeparts import (
    as_instant,
    check_hour,
    default_report_hour,
    hours_touched,
    path_key,
    with_times,
)
from fleetgauge.operators.coverage import device_coverage, device_online, missing_devices
from fleetgauge.operators.dashboard import device_labels, panel_series, select_devices, threshold_state
from fleetgauge.operators.latest import dedup_readings, latest_per_device, recent
from fleetgauge.operators.metrics import batch_gauges, exposition_lines, metric_snapshot
from fleetgauge.operators.partitions import partition_inventory
from fleetgauge.operators.rollup import (
    device_batch_stats,
    hourly_device_mean,
    hourly_device_report,
    round_half_even,
)
from tests.helpers import frame, plan_of, reading


def test_latest_goes_by_time_not_text(spark):
    df = with_times(
        frame(
            spark,
            reading(time="2024-01-01T09:00:00+09:00", sensor1=1.0),
            reading(time="2024-01-01T01:00:00+00:00", sensor1=2.0),
            reading(time="not-a-time", sensor1=3.0),
        )
    )
    assert [r.sensor1 for r in latest_per_device(df).collect()] == [2.0]


def test_ties_fall_to_collection_time_then_id(spark):
    df = with_times(
        frame(
            spark,
            reading(collected_at="2024-01-01T00:00:09", sensor1=1.0),
            reading(collected_at="2024-01-01T00:00:10", sensor1=2.0),
            reading(collected_at="2024-01-01T00:00:10", sensor1=3.0),
        )
    )
    assert latest_per_device(df, ["sensor1"]).first()["sensor1"] == 3.0


def test_groups_are_cut_before_the_shuffle(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr(
        "user_id as DeviceId", "cast(ts as timestamp) event_ts", "cast(ts as timestamp) collected_ts",
        "event_type as time", "value",
    )
    for result in (latest_per_device(df), dedup_readings(df)):
        lines = plan_of(result).splitlines()
        exchange = next(i for i, line in enumerate(lines) if "Exchange" in line)
        assert any("WindowGroupLimit" in line and "Partial" in line for line in lines[exchange:])


def test_recency_is_inclusive(spark):
    df = with_times(
        frame(
            spark,
            reading(collected_at="2024-01-01T11:00:00"),
            reading(collected_at="2024-01-01T10:59:59"),
            reading(collected_at=None),
        )
    )
    assert recent(df, datetime(2024, 1, 1, 12)).count() == 1
    assert recent(df, "2024-01-01 11:59:59").count() == 2


def test_moments_do_not_depend_on_the_drivers_zone(spark, monkeypatch):
    monkeypatch.setenv("TZ", "Asia/Tokyo")
    time.tzset()
    try:
        noon = datetime(2024, 1, 1, 12)
        moments = [noon, "2024-01-01 12:00:00", noon.replace(tzinfo=timezone.utc),
                   datetime(2024, 1, 1, 21, tzinfo=timezone(timedelta(hours=9)))]
        shown = [F.date_format(as_instant(m), "dd HH:mm").alias(f"m{i}") for i, m in enumerate(moments)]
        assert set(spark.range(1).select(*shown).first()) == {"01 12:00"}
    finally:
        monkeypatch.undo()
        time.tzset()


def test_recency_is_pushed_to_the_scan(spark, folder):
    with_times(frame(spark, reading())).write.parquet(f"{folder}/t")
    plan = plan_of(recent(spark.read.parquet(f"{folder}/t"), datetime(2024, 1, 1, 12)))
    assert "GreaterThanOrEqual(collected_ts" in plan


def test_dedup_keeps_the_first_copy(spark):
    df = with_times(
        frame(
            spark,
            reading(collected_at="2024-01-01T00:01:00", sensor1=2.0),
            reading(collected_at="2024-01-01T00:00:30", sensor1=1.0),
            reading(time=None),
            reading(time=None),
        )
    )
    assert sorted(r.sensor1 for r in dedup_readings(df).collect()) == [1.0, 1.0]


def test_snapshot_families(spark):
    late, later = "2024-01-01T05:00:00", "2024-01-01T06:00:00"
    df = with_times(
        frame(
            spark,
            reading(sensor1=10.0),
            reading(time=late, sensor1=500.0, motor1=None),
            reading(time=later, collected_at=later, sensor1=20.0, isFail=True),
            reading(DeviceId=2, sensor1=None, isFail=None),
            reading(DeviceId=None),
        )
    )

    def values(**options):
        return {
            (r.metric, r.device_id): r.value
            for r in metric_snapshot(df, **options).collect()
            if r.metric.endswith("sensor1") or r.device_id == "2"
        }

    got = values()
    assert got["fms_latest_sensor1", "1"] == 10.0
    assert got["fms_err_latest_sensor1", "1"] == 500.0
    assert got["fms_fail_latest_sensor1", "1"] == 20.0
    assert got["fms_raw_latest_sensor1", "1"] == 20.0
    assert ("fms_raw_latest_sensor1", "2") not in got
    assert got["fms_raw_latest_motor1", "2"] == 1.0
    fresh = values(as_of=datetime(2024, 1, 1, 6, 30))
    assert ("fms_latest_sensor1", "1") not in fresh
    assert fresh["fms_fail_latest_sensor1", "1"] == 20.0
    assert fresh["fms_raw_latest_motor1", "2"] == 1.0


def test_recent_family_member_wins_over_a_stale_newer_event(spark):
    df = with_times(
        frame(
            spark,
            reading(time="2024-01-01T09:00:00", collected_at="2024-01-01T01:00:00", sensor1=1.0),
            reading(time="2024-01-01T08:00:00", collected_at="2024-01-01T08:00:00", sensor1=2.0),
        )
    )
    got = {r.metric: r.value for r in metric_snapshot(df, as_of=datetime(2024, 1, 1, 8, 30)).collect()}
    assert got["fms_latest_sensor1"] == 2.0
    assert got["fms_raw_latest_sensor1"] == 1.0


def test_gauges_and_exposition_text(spark):
    stats = device_batch_stats(frame(spark, reading(isFail=True), reading(motor1=3.0)))
    gauges = batch_gauges(stats)
    values = {r.metric: r.value for r in gauges.collect()}
    assert values["fms_device_online"] == 1.0
    assert values["fms_motor1_rpm"] == 2.0
    assert values["fms_failure_rate"] == 50.0
    lines = {r.value for r in exposition_lines(gauges).collect()}
    assert 'fms_motor1_rpm{device_id="1"} 2.0' in lines


def test_report_text(spark):
    df = frame(spark, reading(sensor1=2.0), reading(sensor1=2.01)).selectExpr("*", "'2025070906' ymdh")
    row = hourly_device_report(hourly_device_mean(df)).first()
    assert (row.ymd, row.hh, row.device) == ("20250709", "06", "01")
    assert row.value.split("\n") == [
        "[집계 데이터 : 20250709 - 06]",
        "motor1_avg : 1.0",
        "motor2_avg : 1.0",
        "motor3_avg : 1.0",
        "sensor1_avg : 2.0",
        "sensor2_avg : 1.0",
        "sensor3_avg : 1.0",
    ]


def test_means_skip_nan(spark):
    df = frame(spark, reading(sensor1=float("nan")), reading(sensor1=4.0)).selectExpr("*", "'h' ymdh")
    assert hourly_device_mean(df).first()["sensor1_avg"] == 4.0


def test_rounding(spark):
    df = spark.createDataFrame([(0.125,), (9.435,), (-0.125,), (1.0,)], "x double")
    assert [r.y for r in df.select(round_half_even(F.col("x")).alias("y")).collect()] == [
        0.12, 9.44, -0.12, 1.0,
    ]


def test_coverage(spark):
    df = with_times(frame(spark, reading(), reading(), reading(DeviceId=3), reading(DeviceId=500)))
    counts = {r.DeviceId: r.readings for r in device_coverage(df, 1, 4).collect()}
    assert counts == {1: 2, 2: 0, 3: 1, 4: 0}
    assert {r.DeviceId for r in missing_devices(df, 1, 4).collect()} == {2, 4}
    online = device_online(df, datetime(2024, 1, 1, 0, 30), 60, 1, 4)
    assert {r.DeviceId: r.online for r in online.collect()} == {1: 1, 2: 0, 3: 1, 4: 0}
    gone = device_online(df, datetime(2024, 1, 1, 3), 60, 1, 4)
    assert {r.online for r in gone.collect()} == {0}


def test_device_pattern_is_anchored(spark):
    df = frame(spark, *[reading(DeviceId=i) for i in (1, 10, 11, 21)], reading(DeviceId=None))
    assert {r.DeviceId for r in select_devices(df, "1|2.").collect()} == {1, 21}
    assert select_devices(df).count() == 4
    assert [r.device_id for r in device_labels(df).collect()] == ["1", "10", "11", "21"]


def test_panel_range_includes_both_ends(spark):
    df = with_times(
        frame(spark, *[reading(time=f"2024-01-01T{h}:00:00") for h in ("10", "11", "12", "13")])
    )
    points = panel_series(df, datetime(2024, 1, 1, 12), metrics=["sensor1"])
    assert points.count() == 2


def test_threshold_edges(spark):
    points = spark.createDataFrame(
        [("sensor1", v) for v in (-0.1, 0.0, 89.9, 90.0)], "metric string, value double"
    )
    assert [r.state for r in threshold_state(points).collect()] == ["red", "green", "green", "red"]


def test_hours():
    assert hours_touched(datetime(2024, 1, 1, 0, 10)) == ["2023123123", "2024010100"]
    assert hours_touched(datetime(2024, 1, 1, 5), 60) == ["2024010104", "2024010105"]
    assert default_report_hour(datetime(2025, 7, 8, 22, 5)) == "2025070906"
    assert check_hour("2025070906") == "2025070906"
    for bad in ("20250709", "2025-07-09", ""):
        with pytest.raises(ValueError):
            check_hour(bad)


def test_path_key_pads(spark):
    df = with_times(frame(spark, reading(time="2025-07-09T06:00:01", DeviceId=7)))
    assert df.select(path_key(F.col("event_ts"), F.col("DeviceId"))).first()[0] == "2025/07/09/06/07"


def test_inventory_ignores_other_paths(spark):
    paths = [
        ("t/DeviceId=10/ymdh=2025070906/a.parquet",),
        ("t/DeviceId=9/ymdh=2025070907/a.parquet",),
        ("t/DeviceId=9/ymdh=2025070907/b.parquet",),
        ("t/_SUCCESS",),
    ]
    rows = partition_inventory(spark.createDataFrame(paths, "path string")).collect()
    assert [tuple(r) for r in rows] == [(9, "2025070907"), (10, "2025070906")]
