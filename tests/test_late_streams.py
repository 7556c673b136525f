"""Deduplication over any distance, and the edges of going on- and offline."""

import pytest

from fleetgauge.functions.timeparts import with_times
from fleetgauge.operators.bloom import build_filters, maybe_known, merge_filters
from fleetgauge.streaming import queries as run
from fleetgauge.streaming.online import online_edges
from fleetgauge.streaming.seen import filter_store, seen_batch, stored_rows
from tests.helpers import frame, reading


def at(day, hour, minute=0, second=0, **changes):
    time = f"2024-01-{day:02d}T{hour:02d}:{minute:02d}:{second:02d}"
    return reading(**{"time": time, "collected_at": time, **changes})


def keys_of(rows):
    return sorted(((r.time, r.DeviceId, r.sensor1) for r in rows), key=str)


FIRST = [at(1, 0), at(1, 0), at(1, 5, DeviceId=2), at(1, 0, time=None), at(1, 0, time="nope", DeviceId=None)]
SECOND = [at(2, 0, time="2024-01-01T00:00:00", sensor1=9.0), at(2, 0), at(1, 0, time=None), at(2, 1, time=None)]


@pytest.mark.parametrize("bits, hours", [(1 << 20, 1000), (4, 1000), (1 << 20, 0)])
def test_copies_a_day_later(spark, folder, bits, hours):
    """With four bits every key may be known; the exact look-up decides."""
    store = seen_batch(f"{folder}/out", bits=bits, hours_at_once=hours)
    batches = [with_times(frame(spark, *rows)) for rows in (FIRST, SECOND, FIRST)]
    for batch_id in (0, 1, 1, 2, 0, 2):  # with batches that are run again
        store(batches[batch_id], batch_id)
    kept = stored_rows(spark, f"{folder}/out")
    want = [("2024-01-01T00:00:00", 1), ("2024-01-01T05:00:00", 2), (None, 1), ("nope", None), ("2024-01-02T00:00:00", 1), (None, 1)]
    assert keys_of(kept.collect()) == sorted(((*w, 1.0) for w in want), key=str)
    assert {r.batch_id: r["count"] for r in kept.groupBy("batch_id").count().collect()} == {0: 4, 1: 2}
    hours_of = {r.event_hour for r in kept.collect()}
    assert hours_of == {"2024010100", "2024010105", "2024010200", "none"}
    # State is a filter an hour: folding leaves one row for each bucket in use.
    filters = filter_store(f"{folder}/out", bits)
    filters.fold(spark)
    filters.retire(spark)
    states = filters.states(spark)
    assert states.count() == states.select("event_hour", "bucket").distinct().count()
    store(with_times(frame(spark, *FIRST, *SECOND, at(9, 9))), 3)
    assert stored_rows(spark, f"{folder}/out").filter("batch_id = 3").count() == 1


def test_filters_never_miss(spark):
    rows = spark.range(3000).selectExpr("cast(id % 3 as string) as g", "id", "if(id % 7 = 0, null, id) as v")
    filters = merge_filters(build_filters(rows.limit(1000), "g", ["id", "v"], 1 << 16).unionByName(build_filters(rows, "g", ["id", "v"], 1 << 16)), "g")
    assert maybe_known(rows, filters, "g", ["id", "v"], 1 << 16).count() == 3000
    other = rows.selectExpr("g", "id + 10000 as id", "v")
    assert maybe_known(other, filters, "g", ["id", "v"], 1 << 16).count() < 60
    assert maybe_known(rows.limit(0), filters, "g", ["id", "v"]).count() == 0


@pytest.fixture
def rocks(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, run.ROCKSDB)
    yield
    spark.conf.set(name, before)


def test_edges_over_a_restart(spark, folder, rocks):
    landed, out, checkpoint = f"{folder}/in", f"{folder}/edges", f"{folder}/checkpoint"

    def arrive(*rows):
        """Each call is a stream started anew on the same checkpoint."""
        df = with_times(frame(spark, *rows))
        df.write.mode("append").parquet(landed)
        stream = spark.readStream.schema(df.schema).parquet(landed)
        edges = online_edges(stream, quiet_minutes=60, forget_minutes=600, delay="1 minute")
        run.to_files(edges, out, checkpoint, every=None).awaitTermination()
        found = spark.read.parquet(out).collect()
        return sorted((r.DeviceId, r.changed_at.strftime("%d %H:%M"), r.online) for r in found)

    def states():
        return spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "device").load().count()

    seen = [(1, "01 00:00", 1), (2, "01 00:10", 1)]
    assert arrive(at(1, 0), at(1, 0, 30), at(1, 0, 10, DeviceId=2), at(1, 0, DeviceId=None), at(1, 0, time=None)) == seen
    # Device 1 goes on; device 2 falls silent and is told so when the watermark passes its hour.
    seen += [(2, "01 01:10", 0)]
    assert arrive(at(1, 1, 20)) == sorted(seen)
    # Nothing new on a restart.
    assert arrive() == sorted(seen)
    # A silence inside one batch has both edges; device 1 is offline from its own last reading on.
    seen += [(1, "01 02:20", 0), (2, "01 03:00", 1), (2, "01 04:00", 0), (2, "01 05:00", 1)]
    assert arrive(at(1, 3, DeviceId=2), at(1, 5, DeviceId=2)) == sorted(seen)
    assert states() == 2
    # Much later both are gone and their state is dropped; device 3 keeps its own.
    seen += [(2, "01 06:00", 0), (3, "03 00:00", 1)]
    assert arrive(at(3, 0, DeviceId=3)) == sorted(seen)
    assert states() == 1
    # Who comes back begins anew.
    seen += [(1, "03 00:30", 1)]
    assert arrive(at(3, 0, 30)) == sorted(seen)
    with pytest.raises(ValueError):
        online_edges(with_times(frame(spark)), 60, 60)
