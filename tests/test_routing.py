import random

import pytest
from pyspark.sql import functions as F

from fleetgauge.functions.predicates import is_route
from fleetgauge.operators.routing import take_route, with_route
from fleetgauge.rules import FLEET_RANGES, ROUTES
from fleetgauge.streaming.transforms import route_stream
from tests.helpers import frame, plan_of, reading

EDGES = {
    "ok": ({}, "data"),
    "edge": (
        dict(DeviceId=100, sensor1=100.0, sensor2=0.0, sensor3=150.0, motor1=2000.0,
             motor2=1500.0, motor3=1800.0),
        "data",
    ),
    "out_of_range": (dict(sensor1=101.0), "dataerr"),
    "just_below": (dict(motor2=-0.001), "dataerr"),
    "nan": (dict(sensor1=float("nan")), "dataerr"),
    "null_and_out_of_range": (dict(sensor1=None, sensor2=101.0), "dataerr"),
    "unknown_device": (dict(DeviceId=101), "dataerr"),
    "fail_out_of_range": (dict(sensor1=999.0, isFail=True), "fail"),
    "null_sensor": (dict(sensor1=None), "unrouted"),
    "null_fail": (dict(isFail=None), "unrouted"),
}


@pytest.mark.parametrize("name", EDGES)
def test_edge_rows(spark, name):
    changes, route = EDGES[name]
    df = frame(spark, reading(**changes))
    assert with_route(df).first()["route"] == route
    assert [r for r in ROUTES if not take_route(df, r).isEmpty()] == [
        r for r in ROUTES if r == route
    ]


def test_routes_are_disjoint_and_complete(spark):
    df = frame(spark, *[reading(**changes) for changes, _ in EDGES.values()])
    hits = [F.coalesce(is_route(r).cast("int"), F.lit(0)) for r in ROUTES]
    routed = with_route(df).withColumn("hits", sum(hits[1:], hits[0]))
    assert routed.filter("hits > 1").isEmpty()
    assert routed.filter("(hits = 0) != (route = 'unrouted')").isEmpty()
    assert routed.count() == df.count()


def expected_route(row):
    """The three filters with three-valued logic spelled out; None is unknown."""
    if row["isFail"] is None:
        return "unrouted"
    if row["isFail"]:
        return "fail"
    checks = []
    for rule in FLEET_RANGES:
        value = row[rule.column]
        checks.append(None if value is None else rule.low <= value <= rule.high)
    if False in checks:
        return "dataerr"
    return "unrouted" if None in checks else "data"


def test_random_rows_against_brute_force(spark):
    rng = random.Random(11)
    rows = []
    for n in range(800):
        row = reading(time=str(n), isFail=rng.choice([False, False, False, True, None]))
        for rule in FLEET_RANGES:
            value = rng.choice([rule.low, rule.high, rng.uniform(rule.low, rule.high)])
            if rng.random() < 0.08:
                value = rng.choice([None, rule.low - 1, rule.high + 1])
            if rule.column == "DeviceId":
                value = None if value is None else int(value)
            elif value is not None:
                value = rng.choice([float(value)] * 30 + [float("nan")])
            row[rule.column] = value
        rows.append(row)
    got = {r["time"]: r["route"] for r in with_route(frame(spark, *rows)).collect()}
    assert got == {row["time"]: expected_route(row) for row in rows}
    assert set(got.values()) == {"data", "dataerr", "fail", "unrouted"}


def test_unplaceable_rows_are_rejected(spark):
    df = frame(
        spark,
        reading(),
        reading(time=None),
        reading(time="not-a-time"),
        reading(collected_at=None),
        reading(DeviceId=None),
    )
    routes = [r["route"] for r in route_stream(df, delay=None).collect()]
    assert routes == ["data"] + ["reject"] * 4


def test_unknown_route(spark):
    with pytest.raises(ValueError):
        take_route(frame(spark, reading()), "nowhere")


def test_route_filter_reaches_the_scan(spark, folder):
    frame(spark, reading()).write.parquet(f"{folder}/t")
    plan = plan_of(take_route(spark.read.parquet(f"{folder}/t"), "data").select("DeviceId"))
    assert "GreaterThanOrEqual(sensor1,0.0)" in plan
    assert "LessThanOrEqual(motor3,1800.0)" in plan
