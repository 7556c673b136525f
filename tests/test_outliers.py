import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetgauge.operators import quantiles
from fleetgauge.operators.outliers import flag_iqr, flag_zscore, outlier_bounds, quartiles
from fleetgauge.operators.quantiles import exact_quantiles
from fleetgauge.schema import METRICS
from tests.helpers import frame, plan_of, reading

PROBABILITIES = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]


def columns():
    rng = random.Random(3)
    n = 20_000
    heavy = [5.0 if rng.random() < 0.34 else rng.gauss(0, 10) for _ in range(n)]
    few = [float(rng.choice([1, 2, 3])) for _ in range(n)]
    spread = [rng.random() ** 8 * 1e9 for _ in range(n)]
    holes = [None if rng.random() < 0.5 else rng.random() for _ in range(n)]
    nans = [float("nan") if rng.random() < 0.3 else rng.random() for _ in range(n)]
    same = [7.0] * n
    empty = [None] * n
    return dict(heavy=heavy, few=few, spread=spread, holes=holes, nans=nans, same=same, empty=empty)


@pytest.mark.parametrize("leaf_rows", [5, 60, 50_000])
def test_exact_quantiles(spark, leaf_rows):
    data = columns()
    rows = list(zip(*data.values()))
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in data)).repartition(4)
    found = exact_quantiles(df, list(data), PROBABILITIES, leaf_rows=leaf_rows)
    for name, values in data.items():
        kept = [v for v in values if v is not None and v == v]
        if not kept:
            assert found[name] == [None] * len(PROBABILITIES)
        else:
            np.testing.assert_allclose(found[name], np.quantile(kept, PROBABILITIES), rtol=1e-12)


def test_a_sketch_that_misses_only_costs_time(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "ACCURACY", 10)
    monkeypatch.setattr(quantiles, "MARGIN", 0.001)
    data = {name: columns()[name] for name in ("spread", "heavy")}
    df = spark.createDataFrame(list(zip(*data.values())), "spread double, heavy double")
    found = exact_quantiles(df.repartition(4), list(data), [0.25, 0.66], leaf_rows=500)
    for name, values in data.items():
        np.testing.assert_allclose(found[name], np.quantile(values, [0.25, 0.66]), rtol=1e-12)


def test_sketch_is_within_its_error(spark):
    df = frame(spark, *[reading(sensor1=float(i)) for i in range(1001)])
    q1, q3 = quartiles(df, ["sensor1"], relative_error=0.01)["sensor1"]
    assert abs(q1 - 250) <= 11 and abs(q3 - 750) <= 11


def test_iqr_flags_and_missing_values(spark):
    df = frame(
        spark, *[reading(sensor1=float(i)) for i in range(9)], reading(sensor1=99.0),
        reading(sensor1=None), reading(sensor1=float("nan")),
    )
    flags = {str(r.sensor1): r.sensor1_outlier for r in flag_iqr(df).collect()}
    assert flags.pop("99.0") == "FLAG"
    assert flags.pop("nan") == "FLAG"
    assert set(flags.values()) == {"NORMAL"}


def test_bounds_table(spark):
    df = frame(spark, *[reading(sensor1=float(i)) for i in range(5)])
    row = outlier_bounds(df).filter("metric = 'sensor1'").first()
    assert tuple(row)[1:] == (1.0, 3.0, -2.0, 6.0)


def test_flat_column_has_no_zscore_outliers(spark):
    rows = flag_zscore(frame(spark, *[reading()] * 5)).collect()
    assert all(r[f"{m}_outlier"] == "NORMAL" for r in rows for m in METRICS)


def test_zscore_joins_nothing(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("value").alias("sensor1"))
    plan = plan_of(flag_zscore(df, {"sensor1": 3.0}))
    assert "Join" not in plan and "Cartesian" not in plan
