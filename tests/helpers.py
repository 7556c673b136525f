"""Hand-made readings."""

from fleetgauge.schema import READING

BASE = {
    "time": "2024-01-01T00:00:00.000000",
    "DeviceId": 1,
    "sensor1": 1.0,
    "sensor2": 1.0,
    "sensor3": 1.0,
    "motor1": 1.0,
    "motor2": 1.0,
    "motor3": 1.0,
    "isFail": False,
    "collected_at": "2024-01-01T00:00:01.000000",
}


def reading(**changes):
    return {**BASE, **changes}


def frame(spark, *rows):
    return spark.createDataFrame([tuple(r[c] for c in BASE) for r in rows], READING)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))
