"""Stored states of micro-batches: late rows, replays, folds, and sketches against exact ranks."""

import pytest

from fleetgauge.functions.timeparts import with_hour_key, with_times
from fleetgauge.operators.partials import hour_partials, merge_partials, partial_means
from fleetgauge.operators.rollup import hourly_device_mean
from fleetgauge.operators.sketches import (
    RANK_ERROR,
    flag_by_bounds,
    hour_sketches,
    merge_sketches,
    sketched_bounds,
)
from fleetgauge.plans.readings import timed_readings
from fleetgauge.schema import METRICS
from fleetgauge.streaming import queries as run
from fleetgauge.streaming.stores import numbered_folders
from tests.helpers import frame, reading, rows_of


def timed(spark, *rows):
    return with_hour_key(with_times(frame(spark, *rows)))


def at(hour, minute=0, **changes):
    time = f"2024-01-01T{hour:02d}:{minute:02d}:00"
    return reading(**{"time": time, "collected_at": time, **changes})


EARLY = [at(0, sensor1=1.0), at(0, 1, sensor1=None), at(1, sensor1=float("nan")), at(0, DeviceId=2, motor1=4.0)]
LATE = [at(0, 59, sensor1=4.0), at(1, 2, sensor1=2.0), at(0, 5, DeviceId=None), at(2, sensor1=None)]


def test_late_readings_correct_their_hour(spark, folder):
    store = run.late_hours(f"{folder}/hours")
    assert store.states(spark).collect() == []
    store.store(timed(spark, *EARLY), 0)
    assert rows_of(partial_means(store.states(spark))) == rows_of(hourly_device_mean(timed(spark, *EARLY)))
    whole = rows_of(hourly_device_mean(timed(spark, *EARLY, *LATE)))
    for _ in range(2):  # a replayed batch replaces its own states
        store.store(timed(spark, *LATE), 1)
        assert rows_of(partial_means(store.states(spark))) == whole


def test_folding_changes_nothing(spark, folder):
    store = run.late_hours(f"{folder}/hours")
    for n, rows in enumerate(([EARLY[0]], EARLY[1:], LATE[:2])):
        store.store(timed(spark, *rows), n)
    before = rows_of(partial_means(store.states(spark)))
    store.fold(spark)
    store.store(timed(spark, *LATE[:2]), 2)  # run again although it is folded
    assert rows_of(partial_means(store.states(spark))) == before
    store.store(timed(spark, *LATE[2:]), 3)
    whole = rows_of(hourly_device_mean(timed(spark, *EARLY, *LATE)))
    assert rows_of(partial_means(store.states(spark))) == whole
    # What a batch sees of those before it does not depend on the folds after them.
    assert rows_of(partial_means(store.states(spark, before=3))) == before
    store.fold(spark)
    store.retire(spark)
    assert numbered_folders(spark, f"{folder}/hours/batches/batch_id=*") == []
    assert numbered_folders(spark, f"{folder}/hours/folded/through=*") == [3]
    assert rows_of(partial_means(store.states(spark))) == whole


def test_unfinished_batches_are_not_read(spark, folder):
    import os

    store = run.late_hours(f"{folder}/hours")
    store.store(timed(spark, *EARLY), 0)
    before = rows_of(store.states(spark))
    store.store(timed(spark, *LATE), 1)
    os.remove(f"{folder}/hours/batches/batch_id=1/_SUCCESS")
    assert rows_of(store.states(spark)) == before


def test_partials_merge_in_any_way(spark):
    parts = [hour_partials(timed(spark, *rows)) for rows in ([EARLY[0]], EARLY[1:], LATE)]
    left = merge_partials(merge_partials(parts[0].unionByName(parts[1])).unionByName(parts[2]))
    right = merge_partials(parts[2].unionByName(merge_partials(parts[1].unionByName(parts[0]))))
    assert rows_of(left) == rows_of(right)


@pytest.mark.parametrize("hours", [None, 40])
def test_sketched_quartiles_are_near(spark, hours):
    df = with_hour_key(timed_readings(spark, "/root/testdata/sf0.1"))
    chosen = None
    if hours:
        chosen = sorted(r.ymdh for r in df.filter("ymdh is not null").select("ymdh").distinct().collect())[100 : 100 + hours]
        df = df.filter(df.ymdh.isin(chosen))
    sketches = hour_sketches(with_hour_key(timed_readings(spark, "/root/testdata/sf0.1")))
    bounds = {r.metric: r for r in sketched_bounds(sketches, chosen).collect()}
    assert set(bounds) == set(METRICS)
    exprs = [f"count({m}) as {m}_n" for m in METRICS] + [f"min({m}) as {m}_low" for m in METRICS] + [f"max({m}) as {m}_high" for m in METRICS]
    for m in METRICS:
        for q in ("q1", "q3"):
            value = getattr(bounds[m], q)
            exprs += [f"avg(int({m} < {value}D)) as {m}_{q}_less", f"avg(int({m} <= {value}D)) as {m}_{q}_most"]
    exact = df.selectExpr(*exprs).first()
    for m in METRICS:
        b = bounds[m]
        assert (b.readings, b.lowest, b.highest) == (exact[f"{m}_n"], exact[f"{m}_low"], exact[f"{m}_high"])
        assert b.upper_bound == b.q3 + 1.5 * (b.q3 - b.q1)
        for q, p in (("q1", 0.25), ("q3", 0.75)):
            assert exact[f"{m}_{q}_less"] <= p + RANK_ERROR and exact[f"{m}_{q}_most"] >= p - RANK_ERROR


def test_sketches_of_unknown_values(spark):
    rows = [at(0, sensor1=None), at(0, sensor1=float("nan")), at(1, sensor1=3.0), at(1, DeviceId=2, sensor1=5.0)]
    sketches = hour_sketches(timed(spark, *rows))
    by_device = {(r.DeviceId, r.metric): r for r in sketched_bounds(sketches, by=["DeviceId"]).collect()}
    assert by_device[1, "sensor1"].readings == 1 and by_device[2, "sensor1"].q3 == 5.0
    assert (1, "sensor1") not in {(r.DeviceId, r.metric) for r in sketched_bounds(sketches, ["2024010100"], ["DeviceId"]).collect()}
    assert sketched_bounds(sketches.limit(0)).collect() == []
    assert merge_sketches(sketches).count() == sketches.count()


def test_stored_bounds_flag_a_stream(spark, folder):
    store = run.hour_sketch_store(f"{folder}/sketches")
    store.store(timed(spark, *[at(0, k, sensor1=float(k)) for k in range(50)]), 0)
    df = timed(spark, at(1, sensor1=500.0), at(1, 1, sensor1=20.0), at(1, 2, sensor1=None))
    df.write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{folder}/in")
    flagged = flag_by_bounds(stream, sketched_bounds(store.states(spark)))
    run.to_files(flagged, f"{folder}/out", f"{folder}/checkpoint", every=None).awaitTermination()
    got = {r.sensor1: r.sensor1_outlier for r in spark.read.parquet(f"{folder}/out").collect()}
    assert got == {500.0: "FLAG", 20.0: "NORMAL", None: "NORMAL"}
