"""The jobs chained as an operator would run them."""

import glob
import json
from argparse import Namespace
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.errors import AnalysisException, StreamingQueryException

from fleetgauge import jobs
from fleetgauge.session import scratch_path, scratch_scope
from fleetgauge.sinks import tables
from fleetgauge.sources.bus import bus_options, bus_stream, shard_stream
from fleetgauge.sources.files import HOURLY_GLOB, landed_hours, routed_table
from fleetgauge.streaming import queries
from tests.helpers import BASE, frame, reading, rows_of
from tests.test_streaming import at, land


def test_file_jobs_end_to_end(spark, folder):
    land(folder, "1", at(0, sensor1=2.0), at(0, sensor1=2.0), at(5, DeviceId=2, sensor1=500.0))
    land(folder, "2", at(61, sensor1=4.0), at(62, isFail=True), at(63, time=None))
    with open(f"{folder}/2024/01/01/00/2.json", "a") as out:
        out.write('{"time":"2024-01-01T00:\n')

    def run(*argv):
        jobs.main(list(argv), spark)

    stream = ["--input", f"{folder}/{HOURLY_GLOB}", "--once"]
    run("route", *stream, "--out", f"{folder}/staging", "--checkpoint", f"{folder}/c1")
    hours = ["2024010100", "2024010101"]
    run("compact", "--input", f"{folder}/staging", "--out", f"{folder}/table", "--hours", *hours)
    table = routed_table(spark, f"{folder}/table")
    assert {r.route: r["count"] for r in table.groupBy("route").count().collect()} == {
        "data": 2, "dataerr": 1, "fail": 1, "reject": 1,
    }
    rejects = routed_table(spark, f"{folder}/staging").filter("route = 'reject'")
    assert {r.text for r in rejects.collect()} == {None, '{"time":"2024-01-01T00:'}
    run("snapshot", "--input", f"{folder}/table", "--out", f"{folder}/gauges",
        "--as-of", "2024-01-01T01:30:00")
    gauges = {(r.metric, r.device_id): r.value for r in spark.read.parquet(f"{folder}/gauges").collect()}
    assert gauges["fms_latest_sensor1", "1"] == 4.0
    assert ("fms_err_latest_sensor1", "2") not in gauges
    run("report", "--input", f"{folder}/table", "--out", f"{folder}/reports", "--hour", hours[0])
    (path,) = glob.glob(f"{folder}/reports/ymd=20240101/hh=00/device=01/*.txt")
    with open(path, encoding="utf-8") as text:
        assert "sensor1_avg : 2.0" in text.read()
    run("rules", *stream, "--out", f"{folder}/rules", "--checkpoint", f"{folder}/c2")
    assert spark.read.parquet(f"{folder}/rules/gauges").count() > 0


def test_bad_hour_is_refused(spark, folder):
    with pytest.raises(ValueError):
        jobs.main(["report", "--input", folder, "--out", folder, "--hour", "20240101"], spark)


def test_scope_removes_its_scratch_tables(spark):
    with scratch_scope(spark):
        path = scratch_path(spark, "t")
        spark.range(3).write.parquet(path)
        assert glob.glob(f"{path}/*.parquet")
    assert not glob.glob(path)


def test_landed_hours(spark, folder):
    land(folder, "1", at(0), at(1))
    assert landed_hours(spark, folder, ["2024010100", "2024010101"]).count() == 2


def test_bus_needs_its_connector(spark):
    with pytest.raises(AnalysisException, match="kafka"):
        bus_stream(spark, "localhost:1", "readings", "latest", 1000)


def test_zoned_moment_and_default_hour(spark, folder):
    """The same instant with and without a zone; data stamped now is in the default report's reach."""
    land(folder, "1", at(0, sensor1=2.0), at(61, sensor1=4.0))
    stamp = (datetime.now(timezone.utc) - timedelta(hours=1)).strftime("%Y-%m-%dT%H:%M:%S")
    land(folder, "2", at(0, DeviceId=7, time=stamp, collected_at=stamp))

    def run(*argv):
        jobs.main(list(argv), spark)

    stream = ["--input", f"{folder}/{HOURLY_GLOB}", "--once"]
    run("route", *stream, "--out", f"{folder}/staging", "--checkpoint", f"{folder}/c1", "--delay", "1 hour")
    hour = stamp[:13].replace("-", "").replace("T", "")
    run("compact", "--input", f"{folder}/staging", "--out", f"{folder}/table", "--hours", "2024010100", "2024010101", hour)
    found = []
    for moment in ("2024-01-01T01:30:00", "2024-01-01T10:30:00+09:00"):
        run("snapshot", "--input", f"{folder}/table", "--out", f"{folder}/gauges", "--as-of", moment)
        found.append(sorted(map(tuple, spark.read.parquet(f"{folder}/gauges").collect())))
    assert found[0] == found[1] != []
    run("report", "--input", f"{folder}/table", "--out", f"{folder}/reports")
    assert glob.glob(f"{folder}/reports/ymd={hour[:8]}/hh={hour[8:]}/device=07/*.txt")
    with pytest.raises(SystemExit):
        run("report", "--input", f"{folder}/table", "--out", f"{folder}/reports", "--hour", "2020010100")


def test_a_failing_query_stops_the_others(spark, folder):
    """The failure of the second shows although the first would run for ever."""
    land(folder, "1", at(0))
    lines = spark.readStream.text(f"{folder}/2024/01/01/00")
    endless = queries.to_files(spark.readStream.format("rate").load(), f"{folder}/a", f"{folder}/c1", every="1 second")

    def fail(batch, batch_id):
        raise ValueError("the second query")

    broken = queries.for_batches(lines, fail, f"{folder}/c2", every="1 second")
    with pytest.raises(StreamingQueryException, match="the second query"):
        queries.await_all([endless, broken])
    assert not endless.isActive and not broken.isActive


def test_landing_and_rejects_run_together(spark, folder):
    land(folder, "1", at(0), at(1))
    with open(f"{folder}/2024/01/01/00/1.json", "a") as out:
        out.write("not json\n")
    bus = spark.readStream.text(f"{folder}/2024/01/01/00")
    args = Namespace(out=f"{folder}/landed", checkpoint=f"{folder}/c", rejects=f"{folder}/rejects", once=True, every=None)
    started = jobs.start_landing(bus, args)
    queries.await_all(started)
    assert len(started) == 2 and spark.read.text(f"{folder}/landed").count() == 3
    assert [r.text for r in spark.read.json(f"{folder}/rejects").collect()] == ["not json"]


def test_what_the_bus_is_given(spark):
    df = frame(spark, reading(), reading(DeviceId=None, sensor1=None))
    sent = tables.bus_messages(df)
    assert sent.dtypes == [("key", "string"), ("value", "string")]
    rows = sorted(((r.key, json.loads(r.value)) for r in sent.collect()), key=str)
    assert rows[0][0] == "1" and rows[0][1] == BASE and rows[1][0] is None and rows[1][1]["sensor1"] is None
    tables.publish(df, "localhost:1", "readings", fmt="noop")
    assert bus_options("h:1", "t", "latest", 5) == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "latest", "maxOffsetsPerTrigger": "5",
    }
    assert bus_options("h:1", "t") == {"kafka.bootstrap.servers": "h:1", "subscribe": "t"}
    with pytest.raises(Exception, match="no-such-provider"):
        shard_stream(spark, "s", "r", "no-such-provider")


def test_an_empty_span_leaves_the_last_snapshot(spark, folder, capsys):
    land(folder, "1", at(0, sensor1=2.0))

    def run(*argv):
        jobs.main(list(argv), spark)

    run("route", "--input", f"{folder}/{HOURLY_GLOB}", "--once", "--out", f"{folder}/staging", "--checkpoint", f"{folder}/c1")
    run("compact", "--input", f"{folder}/staging", "--out", f"{folder}/table", "--hours", "2024010100")
    snapshot = ["snapshot", "--input", f"{folder}/table", "--out", f"{folder}/gauges", "--as-of"]
    run(*snapshot, "2024-01-01T00:30:00", "--keep-last")
    before = rows_of(spark.read.parquet(f"{folder}/gauges"))
    run(*snapshot, "2024-05-01T00:30:00", "--keep-last")
    assert "stays" in capsys.readouterr().out and rows_of(spark.read.parquet(f"{folder}/gauges")) == before != []
    run(*snapshot, "2024-05-01T00:30:00")
    assert spark.read.parquet(f"{folder}/gauges").count() == 0


def test_session_defaults_can_be_overridden(spark):
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == queries.ROCKSDB
