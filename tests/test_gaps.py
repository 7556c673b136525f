"""Online spans, outages and scraped samples, against plain loops and with tiny splits."""

from datetime import datetime, timedelta
import random

import pytest

from fleetgauge.operators import outages, scrape
from tests.helpers import rows_of

T0 = datetime(2024, 1, 1)
SCHEMA = "DeviceId int, event_ts timestamp, collected_ts timestamp, sensor1 double"


def _readings(seed):
    drawn = random.Random(seed)
    rows = [(None, T0, T0, 1.0), (3, None, T0, 1.0), (3, None, None, None)]
    for device, count in ((1, 150), (2, 7), (5, 1)):
        at = T0
        for k in range(count):
            at += timedelta(seconds=drawn.choice([0, 1, 59.5, 60, 61, 600, 601, 4000]), microseconds=drawn.choice([0, 1]))
            rows.append((device, at, at + timedelta(seconds=1, microseconds=k), drawn.choice([None, 1.0, 2.0])))
    drawn.shuffle(rows)
    return rows


def _spans(rows, quiet):
    out = []
    for device in sorted({r[0] for r in rows if r[0] is not None and r[1]}):
        before = None
        for at in sorted(r[1] for r in rows if r[0] == device and r[1]):
            if before is None or at - before > timedelta(minutes=quiet):
                silent = None if before is None else (at - before) / timedelta(seconds=1)
                out.append([device, 1 if before is None else out[-1][1] + 1, at, at, 0, silent])
            out[-1][3], out[-1][4], before = at, out[-1][4] + 1, at
    return sorted(map(tuple, out), key=repr)


@pytest.mark.parametrize("seed, bits, quiet", [(1, 16, 10), (2, 3, 10), (3, 1, 1), (4, 3, 100_000)])
def test_spans(spark, seed, bits, quiet):
    rows = _readings(seed)
    found = outages.online_spans(spark.createDataFrame(rows, SCHEMA).repartition(3), quiet, split_bits=bits)
    got = sorted(((r.DeviceId, r.span, r.online_from, r.online_to, r.readings, r.silent_seconds) for r in found.collect()), key=repr)
    assert got == _spans(rows, quiet)


def test_outages_lie_between_spans(spark):
    df = spark.createDataFrame(_readings(5), SCHEMA)
    spans = outages.online_spans(df, 10)
    by_device = {}
    for r in sorted(spans.collect(), key=lambda r: (r.DeviceId, r.span)):
        by_device.setdefault(r.DeviceId, []).append(r)
    want = {(d, a.online_to, b.online_from) for d, own in by_device.items() for a, b in zip(own, own[1:])}
    got = outages.outages(spans).collect()
    assert {(r.DeviceId, r.offline_from, r.offline_to) for r in got} == want and len(got) == len(want) > 5
    totals = {r.DeviceId: r for r in outages.online_seconds(spans).collect()}
    for d, own in by_device.items():
        silent = sum(b.silent_seconds for b in own[1:])
        assert totals[d].spans == len(own) and abs(totals[d].seconds - totals[d].online_seconds - silent) < 1e-3


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert outages.online_spans(empty).collect() == [] and scrape.scraped_series(empty, columns=["sensor1"]).collect() == []


@pytest.mark.parametrize("seed, bits, stale", [(1, 16, 5), (2, 2, 5), (3, 1, 60)])
def test_samples(spark, seed, bits, stale):
    rows = _readings(seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = scrape.scraped_series(df, stale, columns=["sensor1"], split_bits=bits)
    want = []
    for device in {r[0] for r in rows if r[0] is not None}:
        own = sorted((r for r in rows if r[0] == device and r[1]), key=lambda r: (r[1], r[2]))
        if not own:
            continue
        at = own[0][1].replace(second=0, microsecond=0)
        while at < own[-1][1] + timedelta(minutes=stale):
            known = [r for r in own if r[1] <= at]
            if known and at - known[-1][1] < timedelta(minutes=stale) and known[-1][3] is not None:
                want.append((device, at, "sensor1", known[-1][3]))
            at += timedelta(minutes=1)
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_hot_device_is_in_no_single_group(spark):
    """Every group that is sorted or summed holds a split's rows at most."""
    rows = [(1, T0 + timedelta(seconds=k), T0, 1.0) for k in range(400)]
    df = spark.createDataFrame(rows, SCHEMA)
    whole = rows_of(outages.online_spans(df, 10))
    assert rows_of(outages.online_spans(df, 10, split_bits=3)) == whole
    plan = outages.online_spans(df, 10, split_bits=3)._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "+- Window [" in line or "Window [" in line]
    assert windows and all("_split" in line for line in windows)


def test_next_reading_costs_the_same_in_a_long_split(spark):
    """A frame that shrinks towards the last row is summed anew for each row: the square of a split's rows."""
    rows = [(1, T0 + timedelta(seconds=k), T0, float(k)) for k in range(400)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = scrape.scraped_series(df, columns=["sensor1"], split_bits=3)
    plan = got._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "unboundedpreceding" in plan and "unboundedfollowing" not in plan
    assert rows_of(got) == rows_of(scrape.scraped_series(df, columns=["sensor1"]))
