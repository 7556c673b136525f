"""The moving frame against sorting each frame anew."""

import random

import numpy as np
import pytest

from fleetgauge.operators.ordered import in_order, with_halo
from fleetgauge.operators.rolling import Frame, rolling_quantiles


@pytest.mark.parametrize("rows", [1, 2, 7, 100])
def test_frame_keeps_order(rows):
    drawn = random.Random(rows)
    values = [drawn.choice([None, 1.0, 2.0, 2.0, -0.0, 0.0, drawn.random(), float("inf")]) for _ in range(600)]
    frame = Frame(rows)
    for k, value in enumerate(values):
        frame.push(value)
        last = sorted(v for v in values[max(0, k - rows + 1) : k + 1] if v is not None)
        assert frame.sorted == last and len(frame.last) == min(rows, k + 1)
        for p in (0, 0.25, 0.5, 0.75, 1):
            finite = all(abs(v) < 9 for v in last)
            if last and finite:
                assert abs(frame.quantile(p) - np.quantile(last, p)) < 1e-12
            elif not last:
                assert frame.quantile(p) is None
    frame.clear()
    assert frame.quantile(0.5) is None


@pytest.mark.parametrize("bits", [16, 3])
def test_quantiles_of_chains(spark, bits):
    drawn = random.Random(bits)
    rows = [(d, k, drawn.choice([None, float("nan"), drawn.random(), 1.0])) for d, n in ((1, 120), (2, 1), (None, 3)) for k in range(n)]
    df = spark.createDataFrame(rows, "DeviceId int, at int, v double").repartition(3)
    complete = with_halo(in_order(df, ("at",), split_bits=bits), 9, ["v"], bits)
    got = rolling_quantiles(complete, ["v"], 10, (0.25, 0.5)).filter("not _halo and DeviceId is not null").collect()
    assert len(got) == 121
    by_place = {(d, k): v for d, k, v in rows}
    for r in got:
        known = [by_place[r.DeviceId, k] for k in range(max(0, r.at - 9), r.at + 1)]
        known = [v for v in known if v is not None and v == v]
        for p, value in ((0.25, r["_v_0"]), (0.5, r["_v_1"])):
            assert value is None if not known else abs(value - np.quantile(known, p)) < 1e-12


def test_no_rows(spark):
    empty = spark.createDataFrame([], "DeviceId int, at int, v double")
    assert rolling_quantiles(with_halo(in_order(empty, ("at",)), 9, ["v"]), ["v"], 10, (0.5,)).collect() == []
