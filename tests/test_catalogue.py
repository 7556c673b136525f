"""Registered partitions follow the folders, both ways; and rules that hold for a time."""

import os
import shutil
from datetime import datetime

import pytest

from fleetgauge import jobs
from fleetgauge.functions.timeparts import with_hour_key, with_times
from fleetgauge.operators.routing import with_route
from fleetgauge.operators.rulebook import RULES, judge_as_of, rule_table, versions
from fleetgauge.rules import FLEET_RANGES, INGEST_RANGES
from fleetgauge.sinks import catalogue, tables
from tests.helpers import frame, reading

LAYOUT = ("route", "ymdh", "DeviceId")


@pytest.fixture
def table(spark, folder):
    rows = [reading(DeviceId=d, collected_at=f"2024-01-01T0{h}:00:00", sensor1=s) for d in (1, 2) for h in range(3) for s in (1.0, 500.0)]
    df = with_route(with_hour_key(with_times(frame(spark, *rows)))).drop("event_ts", "collected_ts")
    path = f"{folder}/table"
    tables.write_partitioned(df, path)
    spark.sql("DROP TABLE IF EXISTS readings_registered")
    spark.sql(
        "CREATE TABLE readings_registered (time string, sensor1 double, route string, ymdh string, DeviceId int) "
        f"USING parquet PARTITIONED BY (route, ymdh, DeviceId) LOCATION '{path}'"
    )
    yield path
    spark.sql("DROP TABLE IF EXISTS readings_registered")


def registered(spark):
    return {r.partition for r in spark.sql("SHOW PARTITIONS readings_registered").collect()}


def test_both_ways(spark, table):
    on_disk = {f"route={r}/ymdh=202401010{h}/DeviceId={d}" for r in ("data", "dataerr") for h in range(3) for d in (1, 2)}
    assert {r.partition for r in catalogue.listed_partitions(spark, table, LAYOUT).collect()} == on_disk
    assert catalogue.reconcile(spark, "readings_registered", table, LAYOUT) == {"add": 12, "drop": 0}
    assert registered(spark) == on_disk and spark.table("readings_registered").count() == 12
    assert catalogue.reconcile(spark, "readings_registered", table, LAYOUT) == {"add": 0, "drop": 0}
    # One folder goes, one comes, one is empty; what is registered by hand elsewhere stays.
    shutil.rmtree(f"{table}/route=data/ymdh=2024010100/DeviceId=1")
    shutil.copytree(f"{table}/route=data/ymdh=2024010101/DeviceId=2", f"{table}/route=data/ymdh=2024010109/DeviceId=7")
    os.makedirs(f"{table}/route=data/ymdh=2024010110/DeviceId=8")
    assert catalogue.reconcile(spark, "readings_registered", table, LAYOUT) == {"add": 1, "drop": 1}
    gone, new = "route=data/ymdh=2024010100/DeviceId=1", "route=data/ymdh=2024010109/DeviceId=7"
    assert registered(spark) == on_disk - {gone} | {new}
    assert spark.table("readings_registered").filter("DeviceId = 7").count() == 1


def test_job(spark, table, capsys):
    jobs.main(["register", "--table", "readings_registered", "--input", table], spark)
    assert "12 partitions added, 0 dropped" in capsys.readouterr().out
    shutil.rmtree(f"{table}/route=dataerr")
    jobs.main(["register", "--table", "readings_registered", "--input", table], spark)
    assert "0 partitions added, 6 dropped" in capsys.readouterr().out and len(registered(spark)) == 6


def test_statements_are_bounded(monkeypatch):
    monkeypatch.setattr(catalogue, "STATEMENT", 2)
    rows = [(f"route=a%3Ab/ymdh={k}", "add") for k in range(5)] + [("route=o'x/ymdh=1", "drop")]
    found = list(catalogue.statements("t", "/p/", iter(rows)))
    assert [s.count("PARTITION (") for s in found] == [2, 2, 1, 1]
    assert "route='a:b'" in found[0] and "LOCATION '/p/route=a%3Ab/ymdh=0'" in found[0]
    assert found[-1] == "ALTER TABLE t DROP IF EXISTS PARTITION (route='o\\'x', ymdh='1')"


def test_nothing_to_list(spark, folder):
    assert catalogue.listed_partitions(spark, folder, LAYOUT).collect() == []


def day(n, hour=0):
    return datetime(2024, 1, n, hour)


def test_versions_cut_time_at_every_turn(spark):
    rules = [("a", 0.0, 10.0, None, day(5)), ("a", 0.0, 5.0, day(3), None), ("b", 1.0, 2.0, day(4), day(6)), ("b", 1.0, 9.0, day(4), day(6))]
    got = {(r.since, r.until): (r.a_low, r.a_high, r.b_low, r.b_high) for r in versions(spark.createDataFrame(rules, RULES), ["a", "b"]).collect()}
    assert got == {
        (None, day(3)): (0, 10, None, None),
        (day(3), day(4)): (0, 5, None, None),
        (day(4), day(5)): (0, 5, 1, 2),
        (day(5), day(6)): (0, 5, 1, 2),
        (day(6), None): (0, 5, None, None),
    }


def test_readings_are_judged_by_their_day(spark):
    change = "2024-01-02T12:00:00"
    rules = rule_table(spark, FLEET_RANGES, valid_to=change).unionByName(rule_table(spark, INGEST_RANGES, change))
    rows = [
        reading(time="2024-01-02T11:59:59.999999", sensor3=120.0, sensor1=1.0),
        reading(time="2024-01-02T12:00:00", sensor3=120.0, sensor1=2.0),
        reading(time="2024-03-01T00:00:00", motor1=1e9, sensor1=3.0),
        reading(time="1999-01-01T00:00:00", motor1=1e9, sensor1=4.0),
        reading(time="2024-01-01T00:00:00", motor1=None, sensor1=5.0),
        reading(time="2024-01-01T00:00:00", motor1=None, motor2=-1.0, sensor1=6.0),
        reading(time=None, sensor1=7.0),
        reading(time="2024-01-05T00:00:00", isFail=None, sensor1=8.0),
    ]
    df = with_times(frame(spark, *rows)).withColumnRenamed("collected_at", "since")
    judged = judge_as_of(df, rules, [r.column for r in FLEET_RANGES])
    assert judged.columns == [*df.columns, "valid"] and judged.count() == len(rows)
    got = {r.sensor1: r.valid for r in judged.collect()}
    assert got == {1.0: True, 2.0: False, 3.0: True, 4.0: False, 5.0: None, 6.0: False, 7.0: None, 8.0: None}
    # Without rules there is no objection; without readings there are no rows.
    free = judge_as_of(df, rules.limit(0), ["sensor1"])
    assert {r.sensor1: r.valid for r in free.collect()}[2.0] is True
    assert judge_as_of(df.limit(0), rules, ["sensor1"]).collect() == []


def test_stretches_do_not_multiply_readings(spark):
    """As many rules as wanted: one join, and every reading once."""
    ends = [datetime(2024, 1, 1 + k // 24, k % 24) for k in range(200)]
    rules = spark.createDataFrame([("sensor1", 0.0, float(k), a, b) for k, (a, b) in enumerate(zip(ends, ends[1:]))], RULES)
    rows = [reading(time=f"2024-01-0{1 + k % 8}T{k % 24:02d}:30:00", sensor1=50.0) for k in range(60)]
    judged = judge_as_of(with_times(frame(spark, *rows)), rules, ["sensor1"])
    got = judged.collect()
    assert len(got) == 60
    for r in got:
        hour = (r.event_ts - ends[0]).total_seconds() // 3600
        assert r.valid == (hour >= 50)
    assert judged._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter, ") <= 3
