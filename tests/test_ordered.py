"""Order-dependent operators against brute force, with splits of a few rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetgauge.functions.timeparts import with_times
from fleetgauge.operators.gapfill import fill_previous
from fleetgauge.operators.ordered import POSITION, SPLIT, in_order
from fleetgauge.operators.outliers import flag_rolling
from fleetgauge.schema import METRICS
from tests.helpers import frame, reading

ORDER = ("event_ts", "collected_ts")


def stamp(second):
    return f"2024-01-01T{second // 3600:02d}:{second // 60 % 60:02d}:{second % 60:02d}"


@pytest.fixture(scope="module")
def history():
    """Device 1 holds half of the rows; many gaps; each row has a time of its own."""
    rng = random.Random(7)
    rows = []
    for second in rng.sample(range(80_000), 600):
        device = 1 if rng.random() < 0.5 else rng.randint(2, 6)
        values = {
            m: None if rng.random() < 0.6 else round(rng.choice([1, 1, 10]) * rng.random(), 2)
            for m in METRICS
        }
        rows.append(reading(time=stamp(second), collected_at=stamp(second + 1), DeviceId=device, **values))
    return rows


def by_device(rows):
    groups = {}
    for row in sorted(rows, key=lambda r: r["time"]):
        groups.setdefault(row["DeviceId"], []).append(row)
    return groups.values()


def test_splits_are_bounded_and_in_order(spark, history):
    ordered = in_order(with_times(frame(spark, *history)), ORDER, split_bits=4)
    assert ordered.groupBy(SPLIT).count().agg(F.max("count")).first()[0] <= 16
    placed = [(r.DeviceId, r.time) for r in ordered.orderBy(POSITION).collect()]
    assert placed == sorted((r["DeviceId"], r["time"]) for r in history)


@pytest.mark.parametrize("max_gap", [None, 1, 3, 20])
def test_fill_previous(spark, history, max_gap):
    expected = set()
    for rows in by_device(history):
        for i, row in enumerate(rows):
            filled = dict(row)
            for m in METRICS:
                back = rows[max(0, i - max_gap) if max_gap else 0 : i]
                seen = [r[m] for r in back if r[m] is not None]
                if row[m] is None and seen:
                    filled[m] = seen[-1]
            expected.add(tuple(filled.values()))
    df = with_times(frame(spark, *history))
    out = fill_previous(df, order=ORDER, max_gap=max_gap, split_bits=3)
    got = [tuple(r) for r in out.drop("event_ts", "collected_ts").collect()]
    assert len(got) == len(history) and set(got) == expected


def test_gap_lengths(spark):
    values = [1.0, None, None, 4.0]
    df = with_times(
        frame(spark, *[reading(time=stamp(i), sensor1=v) for i, v in enumerate(values)])
    )

    def filled(**options):
        return [r.sensor1 for r in fill_previous(df, **options).orderBy("time").collect()]

    assert filled() == [1.0, 1.0, 1.0, 4.0]
    assert filled(max_gap=1) == [1.0, 1.0, None, 4.0]


def test_unplaced_rows_pass_through(spark):
    df = with_times(
        frame(
            spark,
            reading(sensor1=5.0),
            reading(time=None, sensor1=None),
            reading(time="not-a-time", sensor1=None),
            reading(DeviceId=None, sensor1=None),
        )
    )
    assert sorted(map(str, (r.sensor1 for r in fill_previous(df).collect()))) == ["5.0"] + ["None"] * 3


def test_exact_copies_keep_their_number(spark):
    df = with_times(frame(spark, *[reading()] * 50, reading(time=stamp(5), sensor1=None)))
    out = fill_previous(df, split_bits=2)
    assert out.count() == 51
    assert out.filter("sensor1 = 1.0").count() == 51


@pytest.mark.parametrize("rows", [12, 40])
def test_rolling_flags(spark, history, rows):
    expected = {}
    for group in by_device(history):
        for i, row in enumerate(group):
            for m in METRICS:
                frame_values = [
                    r[m] for r in group[max(0, i - rows + 1) : i + 1] if r[m] is not None
                ]
                flag = "NORMAL"
                if row[m] is not None:
                    q1, q3 = np.quantile(frame_values, [0.25, 0.75])
                    low, high = round(q1 - 1.5 * (q3 - q1), 6), round(q3 + 1.5 * (q3 - q1), 6)
                    flag = "FLAG" if row[m] < low or row[m] > high else "NORMAL"
                expected[row["time"], m] = flag
    out = flag_rolling(with_times(frame(spark, *history)), rows=rows, order=ORDER, split_bits=3)
    got = {(r["time"], m): r[f"{m}_outlier"] for r in out.collect() for m in METRICS}
    assert got == expected
    assert "FLAG" in got.values()
