"""Declared rule sets. They disagree on purpose and are never merged."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Range:
    """Inclusive bounds for one column."""

    column: str
    low: float
    high: float


@dataclass(frozen=True)
class TypeRule:
    """A value that does not cast to ``kind``, or falls outside the bounds, becomes NULL."""

    column: str
    kind: str
    low: float | None = None
    high: float | None = None


# Ranges a reading must satisfy to reach the `data` route.
FLEET_RANGES = (
    Range("sensor1", 0, 100),
    Range("sensor2", 0, 100),
    Range("sensor3", 0, 150),
    Range("motor1", 0, 2000),
    Range("motor2", 0, 1500),
    Range("motor3", 0, 1800),
    Range("DeviceId", 1, 100),
)

# The collector's own gate (sensor3 is tighter than above).
INGEST_REQUIRED = (
    "time", "DeviceId", "sensor1", "sensor2", "sensor3", "motor1", "motor2", "motor3", "isFail",
)
INGEST_RANGES = (
    Range("sensor1", 0, 100),
    Range("sensor2", 0, 100),
    Range("sensor3", 0, 100),
)

# What JSON a field is to hold.
FIELD_KINDS = {
    "time": "text",
    "DeviceId": "whole",
    "sensor1": "number",
    "sensor2": "number",
    "sensor3": "number",
    "motor1": "number",
    "motor2": "number",
    "motor3": "number",
    "isFail": "flag",
    "collected_at": "text",
}

# Type and range rules of the cleansing stream (devices 1 to 5 only).
TYPE_RULES = (
    TypeRule("time", "timestamp"),
    TypeRule("DeviceId", "int", 1, 5),
    TypeRule("sensor1", "float", 0.0, 100.0),
    TypeRule("sensor2", "float", 0.0, 100.0),
    TypeRule("sensor3", "float", 0.0, 150.0),
    TypeRule("motor1", "int", 0, 2000),
    TypeRule("motor2", "int", 0, 1500),
    TypeRule("motor3", "int", 0, 1800),
    TypeRule("isFail", "boolean"),
)

# What the cleansing stream does with a NULL.
REJECT, DEFAULT_0, DEFAULT_FALSE, INTERPOLATE = "REJECT", "DEFAULT_0", "DEFAULT_FALSE", "INTERPOLATE"
NULL_RULES = {
    "time": REJECT,
    "DeviceId": REJECT,
    "sensor1": DEFAULT_0,
    "sensor2": DEFAULT_0,
    "sensor3": DEFAULT_0,
    "motor1": DEFAULT_0,
    "motor2": DEFAULT_0,
    "motor3": DEFAULT_0,
    "isFail": DEFAULT_FALSE,
}

# Outlier settings.
IQR_THRESHOLD = 1.5
ROLLING_ROWS = 100
Z_LIMITS = {
    "sensor1": 3.0,
    "sensor2": 3.0,
    "sensor3": 3.0,
    "motor1": 2.5,
    "motor2": 2.5,
    "motor3": 2.5,
}

# Dashboard limits; a panel is red below 0 and from the limit on.
PANEL_LIMITS = {
    "sensor1": 90.0,
    "sensor2": 90.0,
    "sensor3": 130.0,
    "motor1": 1900.0,
    "motor2": 1400.0,
    "motor3": 1900.0,
}

# Routes, the gauge family each one feeds, and the gauge names.
ROUTES = ("data", "dataerr", "fail")
UNROUTED = "unrouted"
REJECTED = "reject"
FAMILY_OF_ROUTE = {"data": "latest", "dataerr": "err_latest", "fail": "fail_latest"}
RAW_FAMILY = "raw_latest"
METRIC_NAME = "fms_{family}_{metric}"
BATCH_METRIC_NAMES = {
    "online": "fms_device_online",
    "sensor1": "fms_sensor1_value",
    "sensor2": "fms_sensor2_value",
    "sensor3": "fms_sensor3_value",
    "motor1": "fms_motor1_rpm",
    "motor2": "fms_motor2_rpm",
    "motor3": "fms_motor3_rpm",
    "fail_rate": "fms_failure_rate",
    "quality": "fms_data_quality_score",
}

# The fleet, and how long a reading counts as recent.
FIRST_DEVICE, LAST_DEVICE = 1, 100
RETENTION_MINUTES = 60
# How often the metrics server asks, and how long it takes a sample for current.
SCRAPE_MINUTES, STALE_MINUTES = 1, 5
REPORT_UTC_OFFSET_HOURS = 9

# Layout of the hourly text report.
REPORT_HEADER = "[집계 데이터 : %s - %s]"
REPORT_METRICS = ("motor1", "motor2", "motor3", "sensor1", "sensor2", "sensor3")
