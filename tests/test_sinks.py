import glob

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from fleetgauge.functions.timeparts import with_calendar
from fleetgauge.operators.partitions import partition_inventory
from fleetgauge.operators.rollup import hourly_device_mean, hourly_device_report
from fleetgauge.sinks import tables
from fleetgauge.sources.files import file_listing, hour_slice, landed_json, routed_hours, routed_table
from fleetgauge.streaming.transforms import route_stream
from tests.helpers import frame, plan_of, reading, rows_of

HOURS = ["2024010100", "2024010101"]


@pytest.fixture
def routed(spark):
    df = frame(
        spark,
        reading(),
        reading(DeviceId=2, sensor1=500.0),
        reading(DeviceId=2, isFail=True, collected_at="2024-01-01T01:00:00"),
        reading(sensor2=None),
    )
    return route_stream(df, delay=None)


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_routed_round_trip(spark, folder, routed, fmt):
    tables.write_partitioned(routed, f"{folder}/t", fmt=fmt)
    back = spark.read.schema(routed.schema).format(fmt).load(f"{folder}/t")
    assert rows_of(back.select(*routed.columns)) == rows_of(routed)


def test_hour_slice_prunes_partitions(spark, folder, routed):
    tables.write_partitioned(routed, f"{folder}/t")
    table = routed_table(spark, f"{folder}/t")
    part = hour_slice(table, HOURS[:1], route="dataerr", devices=[2])
    assert [r.sensor1 for r in part.collect()] == [500.0]
    pruned = plan_of(part).split("PartitionFilters: [")[1].split("], PushedFilters")[0]
    assert all(name in pruned for name in ("ymdh", "2024010100", "dataerr", "DeviceId"))
    assert "Filter (" not in plan_of(part)
    assert dict(table.dtypes)["ymdh"] == "string"
    assert hour_slice(table, ["2030010100"]).isEmpty()


def test_hours_are_read_without_listing_the_table(spark, folder, routed):
    tables.write_partitioned(routed, f"{folder}/t")
    part = routed_hours(spark, f"{folder}/t", [HOURS[0], "2030010100"], ["data", "dataerr"])
    assert {(r.route, r.ymdh, r.DeviceId) for r in part.collect()} == {
        ("data", HOURS[0], 1), ("dataerr", HOURS[0], 2),
    }
    assert all(f"ymdh={HOURS[0]}" in path for path in part.inputFiles())
    assert routed_hours(spark, f"{folder}/t", HOURS).count() == 4
    assert routed_hours(spark, f"{folder}/t", ["2030010100"]).isEmpty()
    assert routed_hours(spark, f"{folder}/none", HOURS).isEmpty()


def test_missing_table_is_empty_other_errors_surface(spark, folder):
    assert routed_table(spark, f"{folder}/none").isEmpty()
    assert landed_json(spark, f"{folder}/none").isEmpty()
    with pytest.raises((AnalysisException, ValueError)):
        hour_slice(routed_table(spark, f"{folder}/none"), ["2024"])


def test_json_lines_are_rows(spark, folder, routed):
    frame(spark, *[reading()] * 5).coalesce(1).write.json(f"{folder}/j")
    assert landed_json(spark, f"{folder}/j").count() == 5


def test_compaction_is_repeatable(spark, folder, routed):
    for batch in (0, 1):
        routed.write.partitionBy(*tables.LAYOUT).parquet(f"{folder}/staging/batch_id={batch}")
    staged = spark.read.parquet(f"{folder}/staging").withColumn("ymdh", F.col("ymdh").cast("string"))
    for _ in range(2):
        tables.compact_hours(staged, f"{folder}/t", HOURS[:1])
    table = routed_table(spark, f"{folder}/t")
    assert table.count() == 6
    tables.compact_hours(staged, f"{folder}/t", HOURS[1:])
    assert routed_table(spark, f"{folder}/t").count() == 8
    files = glob.glob(f"{folder}/t/route=data/ymdh=2024010100/DeviceId=1/*.parquet")
    assert len(files) == 1


def test_raw_archive_and_cleansed(spark, folder, routed):
    tables.write_raw_archive(with_calendar(routed).drop("hour"), f"{folder}/raw")
    assert glob.glob(f"{folder}/raw/DeviceId=2/year=2024/month=1/day=1/*.gz.parquet")
    tables.write_cleansed(routed, f"{folder}/clean")
    assert spark.read.parquet(f"{folder}/clean").count() == 4


def test_reports_are_filed_and_replaced(spark, folder, routed):
    means = hourly_device_mean(routed.filter("route = 'data'"))
    for _ in range(2):
        tables.write_reports(hourly_device_report(means), f"{folder}/reports")
    files = glob.glob(f"{folder}/reports/ymd=20240101/hh=00/device=01/*.txt")
    assert len(files) == 1
    with open(files[0], encoding="utf-8") as text:
        assert text.read().startswith("[집계 데이터 : 20240101 - 00]\nmotor1_avg : 1.0\n")


def test_snapshot_is_replaced(spark, folder):
    schema = "metric string, device_id string, value double"
    tables.write_snapshot(spark.createDataFrame([("m", "1", 1.0), ("m", "2", 2.0)], schema), f"{folder}/s")
    smaller = spark.createDataFrame([("m", "1", 3.0)], schema)
    tables.write_snapshot(smaller, f"{folder}/s")
    assert [tuple(r) for r in spark.read.parquet(f"{folder}/s").collect()] == [("m", "1", 3.0)]
    tables.write_exposition(smaller, f"{folder}/x")
    assert [r.value for r in spark.read.text(f"{folder}/x").collect()] == ['m{device_id="1"} 3.0']


def test_register_partitions(spark, folder, routed):
    layout = ("DeviceId", "ymdh")
    tables.write_partitioned(routed.select("sensor1", *layout), f"{folder}/t", layout)
    found = partition_inventory(file_listing(spark, f"{folder}/t")).collect()
    assert [tuple(r) for r in found] == [(1, HOURS[0]), (2, HOURS[0]), (2, HOURS[1])]
    columns = "sensor1 double, DeviceId int, ymdh string"
    spark.sql("DROP TABLE IF EXISTS readings_registered")
    tables.register_table(spark, "readings_registered", f"{folder}/t", columns, layout)
    assert spark.table("readings_registered").count() == 4
    spark.sql("DROP TABLE IF EXISTS readings_added")
    spark.sql(
        f"CREATE TABLE readings_added ({columns}) USING parquet "
        f"PARTITIONED BY (DeviceId, ymdh) LOCATION '{folder}/t'"
    )
    assert spark.table("readings_added").isEmpty()
    for _ in range(2):
        tables.add_partition(spark, "readings_added", f"{folder}/t", 2, HOURS[1])
    assert spark.table("readings_added").count() == 1


def test_own_layout_is_listed_and_registered(spark, folder, routed):
    tables.write_partitioned(routed, f"{folder}/own")
    found = partition_inventory(file_listing(spark, f"{folder}/own")).collect()
    assert {(r.DeviceId, r.ymdh) for r in found} == {
        (r.DeviceId, r.ymdh) for r in routed.filter("DeviceId is not null and ymdh is not null").collect()
    }
    spark.sql("DROP TABLE IF EXISTS readings_own")
    spark.sql(
        f"CREATE TABLE readings_own (sensor1 double, route string, ymdh string, DeviceId int) USING parquet "
        f"PARTITIONED BY (route, ymdh, DeviceId) LOCATION '{folder}/own'"
    )
    one = routed.filter("route = 'data'").first()
    for _ in range(2):
        tables.add_partition(spark, "readings_own", f"{folder}/own", one.DeviceId, one.ymdh, "data")
    same = routed.filter(F.col("DeviceId") == one.DeviceId).filter(F.col("ymdh") == one.ymdh).filter("route = 'data'")
    assert spark.table("readings_own").count() == same.count()
    spark.sql("DROP TABLE readings_own")
