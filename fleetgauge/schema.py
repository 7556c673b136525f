"""The one record type: a flat reading, one row per poll of a device."""

from __future__ import annotations

from pyspark.sql import types as T

KEY = "DeviceId"
SENSORS = ("sensor1", "sensor2", "sensor3")
MOTORS = ("motor1", "motor2", "motor3")
METRICS = SENSORS + MOTORS


def reading_schema(metric_type: T.DataType | None = None, collected_at: bool = True) -> T.StructType:
    """Declared schema of a reading; nothing is ever inferred from the data.

    The rules stream reads its metrics as floats and has no ``collected_at``;
    both are arguments so that every stream shares this one definition.
    """
    metric = metric_type or T.DoubleType()
    fields = [T.StructField("time", T.StringType()), T.StructField(KEY, T.IntegerType())]
    fields += [T.StructField(name, metric) for name in METRICS]
    fields.append(T.StructField("isFail", T.BooleanType()))
    if collected_at:
        fields.append(T.StructField("collected_at", T.StringType()))
    return T.StructType(fields)


READING = reading_schema()
READING_COLUMNS = tuple(READING.fieldNames())
