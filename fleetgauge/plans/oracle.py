"""The SQL each registered query is checked against, in DuckDB's dialect."""

from __future__ import annotations

# Fixed values, written out again: the SQL takes none of them from the code it checks.
METRICS = ("sensor1", "sensor2", "sensor3", "motor1", "motor2", "motor3")
READING_COLUMNS = ("time", "DeviceId", *METRICS, "isFail", "collected_at")
FLEET_RANGES = {
    "sensor1": (0, 100),
    "sensor2": (0, 100),
    "sensor3": (0, 150),
    "motor1": (0, 2000),
    "motor2": (0, 1500),
    "motor3": (0, 1800),
    "DeviceId": (1, 100),
}
Z_LIMITS = {"sensor1": 3.0, "sensor2": 3.0, "sensor3": 3.0, "motor1": 2.5, "motor2": 2.5, "motor3": 2.5}
PANEL_LIMITS = {"sensor1": 90.0, "sensor2": 90.0, "sensor3": 130.0, "motor1": 1900.0, "motor2": 1400.0, "motor3": 1900.0}
FAMILY_OF_ROUTE = {"data": "latest", "dataerr": "err_latest", "fail": "fail_latest"}
RAW_FAMILY = "raw_latest"
MESSAGE_CUT = 20

ISO = "%Y-%m-%dT%H:%M:%S.%f"
MICROS = "%Y-%m-%d %H:%M:%S.%f"
ROW = ", ".join(("event_id", *READING_COLUMNS))
SHORT = 'event_id, DeviceId, collected_at'
LIST = ", ".join(METRICS)

BASE = f"""
base AS (
  SELECT CAST(user_id % 103 + 1 AS INT) AS DeviceId,
    CASE WHEN event_id % 199 = 11 THEN 'not-a-time' WHEN event_id % 199 = 12 THEN NULL
         ELSE strftime(ts, '{ISO}') END AS time,
    CASE WHEN event_id % 97 = 5 THEN NULL ELSE value END AS sensor1,
    CASE WHEN event_id % 89 = 7 THEN NULL
         ELSE CAST(event_id * 37 % 1050 AS DOUBLE) / CAST(10 AS DOUBLE) END AS sensor2,
    CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) * CAST(1.55 AS DOUBLE) AS sensor3,
    CAST(event_id * 7919 % 2050 AS DOUBLE) AS motor1,
    CAST(event_id * 104729 % 1530 AS DOUBLE) AS motor2,
    CAST(event_id * 1299709 % 1830 AS DOUBLE) AS motor3,
    CASE WHEN event_id % 211 = 3 THEN NULL ELSE event_type = 'error' END AS isFail,
    strftime(ts + to_seconds(CAST(event_id % 7 + 60 * copy AS INT)), '{ISO}') AS collected_at,
    event_id
  FROM events CROSS JOIN (SELECT 0 AS copy UNION ALL SELECT 1 AS copy) c
  WHERE copy = 0 OR event_id % 20 = 0
), readings AS (
  SELECT *, TRY_CAST(time AS TIMESTAMP) AS event_ts,
    TRY_CAST(collected_at AS TIMESTAMP) AS collected_ts,
    strftime(TRY_CAST(collected_at AS TIMESTAMP), '%Y%m%d%H') AS ymdh
  FROM base
)"""



def _r4(value: str) -> str:
    return f"floor(({value}) * 10000 + 0.500001) / 10000"


VALID = " AND ".join(f"{c} BETWEEN {low} AND {high}" for c, (low, high) in FLEET_RANGES.items())
VALID = f"({VALID} AND isFail IN (TRUE, FALSE))"
ROUTE_FILTER = {
    "data": f"isFail = FALSE AND {VALID}",
    "dataerr": f"isFail = FALSE AND NOT {VALID}",
    "fail": "isFail = TRUE",
}
ROUTE = (
    "CASE " + " ".join(f"WHEN {cond} THEN '{r}'" for r, cond in ROUTE_FILTER.items())
    + " ELSE 'unrouted' END"
)
NEWEST = "event_ts DESC NULLS LAST, collected_ts DESC NULLS LAST, event_id DESC"
OLDEST = "event_ts, collected_ts, event_id"
SLICE = "ymdh IN ('2024011511', '2024011512')"
NOW = "(SELECT max(collected_ts) FROM readings)"

TYPED = f"""
typed AS (
  SELECT event_id, collected_at,
    CASE WHEN TRY_CAST(time AS TIMESTAMP) IS NOT NULL THEN time END AS time,
    CASE WHEN DeviceId BETWEEN 1 AND 5 THEN DeviceId END AS DeviceId,
    CASE WHEN CAST(sensor1 AS FLOAT) BETWEEN 0 AND 100 THEN sensor1 END AS sensor1,
    CASE WHEN CAST(sensor2 AS FLOAT) BETWEEN 0 AND 100 THEN sensor2 END AS sensor2,
    CASE WHEN CAST(sensor3 AS FLOAT) BETWEEN 0 AND 150 THEN sensor3 END AS sensor3,
    CASE WHEN trunc(motor1) BETWEEN 0 AND 2000 THEN motor1 END AS motor1,
    CASE WHEN trunc(motor2) BETWEEN 0 AND 1500 THEN motor2 END AS motor2,
    CASE WHEN trunc(motor3) BETWEEN 0 AND 1800 THEN motor3 END AS motor3,
    isFail
  FROM readings
)"""
_WHOLE = ", ".join(f"CAST(trunc(coalesce({m}, 0)) AS INT) AS {m}" for m in METRICS[3:])
_ZERO = ", ".join(f"coalesce({m}, 0) AS {m}" for m in METRICS[:3])
CLEAN = f"""
{TYPED.strip()}, cleansed AS (
  SELECT event_id, time, DeviceId, {_ZERO}, {_WHOLE},
    coalesce(isFail, FALSE) AS isFail, collected_at
  FROM typed WHERE time IS NOT NULL AND DeviceId IS NOT NULL
)"""


def _ranked(condition: str = "TRUE", by: str = "DeviceId") -> str:
    return (
        f"SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY {NEWEST}) AS rn "
        f"FROM readings WHERE event_ts IS NOT NULL AND {condition}"
    )


def _latest(condition: str) -> str:
    return (
        f"WITH {BASE} SELECT DeviceId, event_id, time, {LIST} "
        f"FROM ({_ranked(condition)}) WHERE rn = 1"
    )


def _long(source: str, ids: str, value: str = "value") -> str:
    parts = [
        f"SELECT {ids}, '{m}' AS metric, {m} AS {value} FROM {source} WHERE {m} IS NOT NULL"
        for m in METRICS
    ]
    return " UNION ALL ".join(parts)


def _families(recent: bool) -> str:
    fresh = f" AND collected_ts >= {NOW} - INTERVAL 60 MINUTE" if recent else ""
    parts = [f"SELECT '{RAW_FAMILY}' AS family, * FROM ({_ranked()}) WHERE rn = 1"]
    for route, family in FAMILY_OF_ROUTE.items():
        ranked = _ranked(ROUTE_FILTER[route] + fresh)
        parts.append(f"SELECT '{family}' AS family, * FROM ({ranked}) WHERE rn = 1")
    return "winners AS (" + " UNION ALL ".join(parts) + ")"


def _snapshot(recent: bool) -> str:
    return (
        f"WITH {BASE}, {_families(recent)}, long AS ({_long('winners', 'family, DeviceId')}) "
        "SELECT 'fms_' || family || '_' || metric AS metric, "
        "CAST(DeviceId AS VARCHAR) AS device_id, value FROM long"
    )


MEANS = (
    "means AS (SELECT DeviceId, ymdh, "
    + ", ".join(f"avg({m}) AS {m}_avg" for m in METRICS)
    + f" FROM readings WHERE {ROUTE_FILTER['data']} GROUP BY DeviceId, ymdh)"
)
STATS = (
    "max(TRY_CAST(time AS TIMESTAMP)) AS latest_time, "
    + ", ".join(f"{_r4(f'avg({m})')} AS {m}" for m in METRICS)
    + f", {_r4('avg(CAST(isFail AS INT)) * 100')} AS fail_rate"
)
_REPORT = " || chr(10) || ".join(
    f"'{m}_avg : ' || CAST(round_even(round({m}_avg * 100, 6), 0) / 100 AS VARCHAR)"
    for m in ("motor1", "motor2", "motor3", "sensor1", "sensor2", "sensor3")
)
_JSON_PARTS = []
for _c in READING_COLUMNS:
    if _c in ("time", "collected_at"):
        _shown = f"""'"' || {_c} || '"'"""
    elif _c == "isFail":
        _shown = "CASE WHEN isFail THEN 'true' WHEN NOT isFail THEN 'false' END"
    else:
        _shown = f"CAST({_c} AS VARCHAR)"
    _JSON_PARTS.append(f"""'"{_c}":' || coalesce({_shown}, 'null')""")
MESSAGE = "'{' || " + " || ',' || ".join(_JSON_PARTS) + " || '}'"
SENT = f"""
sent AS (
  SELECT event_id, CASE WHEN event_id % 97 = 0 THEN substr({MESSAGE}, 1, {MESSAGE_CUT})
                        ELSE {MESSAGE} END AS text
  FROM readings
)"""


UNEVEN = f"""
uneven AS (
  SELECT event_id, CASE WHEN event_id % 97 = 0 THEN substr(text, 1, 20) ELSE text END AS text FROM (
  SELECT event_id, CASE WHEN event_id % 79 = 11 THEN regexp_replace(text, '"DeviceId":([0-9]+)', '"DeviceId":"\\1"') ELSE text END AS text FROM (
  SELECT event_id, CASE WHEN event_id % 73 = 7 THEN regexp_replace(text, '"isFail":[^,]*,', '') ELSE text END AS text FROM (
  SELECT event_id, CASE WHEN event_id % 71 = 5 THEN regexp_replace(text, '"sensor3":[^,]*', '"sensor3":"hot"') ELSE text END AS text FROM (
  SELECT event_id, CASE WHEN event_id % 67 = 3 THEN regexp_replace(text, '"motor1":[^,]*,', '') ELSE text END AS text FROM (
  SELECT event_id, CASE WHEN event_id % 61 = 2 THEN regexp_replace(text, '"motor2":[^,]*', '"motor2":null') ELSE text END AS text FROM (
  SELECT event_id, {MESSAGE} AS text FROM readings
  ))))))
)"""
_JSON_TYPES = {"time": "'VARCHAR'", "DeviceId": "'UBIGINT', 'BIGINT'", "isFail": "'BOOLEAN'"}


def _failed(field: str) -> str:
    """The first failed check of a field of the valid messages, and whether it turns them away."""
    found = f"json_type(text, '$.{field}')"
    types = _JSON_TYPES.get(field, "'DOUBLE', 'UBIGINT', 'BIGINT'")
    ranged = field.startswith("sensor")
    number = f"TRY_CAST(json_extract_string(text, '$.{field}') AS DOUBLE)"
    beyond = f" WHEN NOT ({number} BETWEEN 0 AND 100) THEN 'out of range'" if ranged else ""
    return (
        f"SELECT event_id, text, '{field}' AS field, CASE WHEN {found} IS NULL THEN 'absent' WHEN {found} = 'NULL' "
        f"THEN 'null' WHEN {found} NOT IN ({types}) THEN 'wrong type'{beyond} END AS reason, "
        f"{'TRUE' if ranged else found + ' IS NULL'} AS blocks FROM whole"
    )


def _field(name: str, kind: str) -> str:
    return f"TRY_CAST(json_extract_string(text, '$.{name}') AS {kind}) AS {name}"


_KINDS = {"time": "VARCHAR", "DeviceId": "INT", "isFail": "BOOLEAN", "collected_at": "VARCHAR"}
_FIELDS = ", ".join(_field(c, _KINDS.get(c, "DOUBLE")) for c in READING_COLUMNS)


def _bounds(source: str = "readings") -> str:
    cuts = ", ".join(
        f"quantile_cont({m}, 0.25) AS {m}_q1, quantile_cont({m}, 0.75) AS {m}_q3" for m in METRICS
    )
    return f"cuts AS (SELECT {cuts} FROM {source})"


def _iqr_flag(metric: str) -> str:
    q1, q3 = f"{metric}_q1", f"{metric}_q3"
    return (
        f"CASE WHEN {metric} < round({q1} - 1.5 * ({q3} - {q1}), 6) "
        f"OR {metric} > round({q3} + 1.5 * ({q3} - {q1}), 6) "
        f"THEN 'FLAG' ELSE 'NORMAL' END AS {metric}_outlier"
    )


_BOUND_ROWS = " UNION ALL ".join(
    f"SELECT '{m}' AS metric, round({m}_q1, 6) AS q1, round({m}_q3, 6) AS q3, "
    f"round({m}_q1 - 1.5 * ({m}_q3 - {m}_q1), 6) AS lower_bound, "
    f"round({m}_q3 + 1.5 * ({m}_q3 - {m}_q1), 6) AS upper_bound FROM cuts"
    for m in METRICS
)
_MOMENTS = ", ".join(f"avg({m}) AS {m}_mean, stddev_pop({m}) AS {m}_sd" for m in METRICS)
_Z_FLAGS = ", ".join(
    f"CASE WHEN round(abs({m} - {m}_mean) / nullif({m}_sd, 0), 6) > {z} "
    f"THEN 'FLAG' ELSE 'NORMAL' END AS {m}_outlier"
    for m, z in Z_LIMITS.items()
)
_ROLLING = ", ".join(
    f"quantile_cont({m}, 0.25) OVER w AS {m}_q1, quantile_cont({m}, 0.75) OVER w AS {m}_q3"
    for m in METRICS
)
_NO_FLAGS = ", ".join(f"'NORMAL' AS {m}_outlier" for m in METRICS)


def _fill(frame: str) -> str:
    filled = ", ".join(
        f"coalesce({m}, last_value({m} IGNORE NULLS) OVER w) AS {m}" for m in METRICS
    )
    return (
        f"WITH {BASE} SELECT event_id, time, DeviceId, {filled}, isFail, collected_at "
        f"FROM readings WHERE event_ts IS NOT NULL "
        f"WINDOW w AS (PARTITION BY DeviceId ORDER BY {OLDEST} ROWS BETWEEN {frame}) "
        f"UNION ALL SELECT event_id, time, DeviceId, {LIST}, isFail, collected_at "
        f"FROM readings WHERE event_ts IS NULL"
    )


def _newest_known(group: str) -> str:
    """Last known value per metric, as the first of its non-NULL rows in newest order."""
    parts = []
    for m in METRICS:
        ranked = (
            f"SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY {NEWEST}) AS rn "
            f"FROM timed WHERE {m} IS NOT NULL"
        )
        parts.append(f"SELECT {group}, '{m}' AS metric, {m} AS value FROM ({ranked}) WHERE rn = 1")
    return " UNION ALL ".join(parts)


_LIMITS = " ".join(f"WHEN '{m}' THEN {v}" for m, v in PANEL_LIMITS.items())
FLEET = "fleet AS (SELECT CAST(i AS INT) AS DeviceId FROM range(1, 101) t(i))"


def _row(condition: str) -> str:
    return f"WITH {BASE} SELECT {ROW} FROM readings WHERE {condition}"


def _build() -> dict[str, str]:
    sql = {
        "to_message": f"WITH {BASE} SELECT event_id, CAST(DeviceId AS VARCHAR) AS key, "
        f"{MESSAGE} AS value FROM readings",
        "parse_json": f"WITH {BASE}, {SENT} SELECT event_id, {_FIELDS} FROM sent "
        "WHERE json_valid(text)",
        "malformed_json": f"WITH {BASE}, {SENT} SELECT event_id, text FROM sent "
        "WHERE NOT json_valid(text)",
        "derive_time": f"WITH {BASE} SELECT {SHORT}, strftime(event_ts, '{MICROS}') AS event_ts, "
        f"strftime(collected_ts, '{MICROS}') AS collected_ts, ymdh, "
        "CAST(year(event_ts) AS INT) AS year, CAST(month(event_ts) AS INT) AS month, "
        "CAST(day(event_ts) AS INT) AS day, CAST(hour(event_ts) AS INT) AS hour FROM readings",
        "path_key": f"WITH {BASE} SELECT {SHORT}, strftime(event_ts, '%Y/%m/%d/%H/') || "
        "printf('%02d', DeviceId) AS path_key FROM readings WHERE event_ts IS NOT NULL",
        "cast_motors": f"WITH {BASE} SELECT {SHORT}, "
        + ", ".join(f"CAST(trunc({m}) AS INT) AS {m}" for m in METRICS[3:])
        + " FROM readings",
        "valid_range_flag": f"WITH {BASE} SELECT {SHORT}, {VALID} AS valid FROM readings",
        "route_counts": f"WITH {BASE} SELECT {ROUTE} AS route, count(*) AS readings "
        "FROM readings GROUP BY 1",
        "reject_null_keys": _row("time IS NOT NULL AND DeviceId IS NOT NULL"),
        "alerts": _row("time IS NULL OR DeviceId IS NULL"),
        "ingest_gate": _row(
            " AND ".join(f"{c} IS NOT NULL" for c in READING_COLUMNS[:-1])
            + " AND "
            + " AND ".join(f"{m} BETWEEN 0 AND 100" for m in METRICS[:3])
        ),
        "ingest_gate_messages": f"WITH {BASE}, {UNEVEN}, whole AS (SELECT * FROM uneven WHERE json_valid(text)), "
        "failed AS (SELECT * FROM ("
        + " UNION ALL ".join(_failed(c) for c in READING_COLUMNS[:-1])
        + ") WHERE reason IS NOT NULL), turned AS (SELECT DISTINCT event_id, text FROM failed WHERE blocks) "
        "SELECT u.event_id, CASE WHEN json_valid(u.text) AND t.event_id IS NULL THEN 'true' ELSE 'false' END AS passes, "
        "f.field, CASE WHEN json_valid(u.text) THEN f.reason ELSE 'malformed' END AS reason "
        "FROM uneven u LEFT JOIN failed f ON f.event_id = u.event_id AND f.text = u.text "
        "LEFT JOIN turned t ON t.event_id = u.event_id AND t.text = u.text",
        "validate_types": f"WITH {BASE}, {TYPED} SELECT {ROW} FROM typed",
        "handle_nulls": f"WITH {BASE} SELECT event_id, time, DeviceId, "
        + ", ".join(f"coalesce({m}, 0) AS {m}" for m in METRICS)
        + ", coalesce(isFail, FALSE) AS isFail, collected_at FROM readings "
        "WHERE time IS NOT NULL AND DeviceId IS NOT NULL",
        "cleanse": f"WITH {BASE}, {CLEAN} SELECT {ROW} FROM cleansed",
        "latest_raw": _latest("TRUE"),
        "latest_count": f"WITH {BASE}, {_families(False)} SELECT family, count(*) AS devices "
        "FROM winners GROUP BY family",
        "recent_readings": f"WITH {BASE} SELECT {SHORT} FROM readings "
        f"WHERE collected_ts >= {NOW} - INTERVAL 60 MINUTE",
        "dedup_readings": f"WITH {BASE} SELECT {ROW} FROM (SELECT *, CASE WHEN event_ts IS NULL THEN 1 ELSE row_number() "
        "OVER (PARTITION BY event_ts, DeviceId ORDER BY collected_ts NULLS LAST, event_id) END AS rn "
        "FROM readings) WHERE rn = 1",
        "hour_slice": f"WITH {BASE} SELECT {SHORT}, {ROUTE} AS route, ymdh FROM readings "
        f"WHERE {SLICE}",
        "hourly_device_mean": f"WITH {BASE}, {MEANS} SELECT DeviceId, ymdh, "
        + ", ".join(f"{_r4(m + '_avg')} AS {m}_avg" for m in METRICS)
        + " FROM means",
        "hourly_device_report": f"WITH {BASE}, {MEANS} SELECT substr(ymdh, 1, 8) AS ymd, "
        "substr(ymdh, 9, 2) AS hh, printf('%02d', DeviceId) AS device, "
        "'[집계 데이터 : ' || substr(ymdh, 1, 8) || ' - ' || substr(ymdh, 9, 2) || ']' || chr(10) "
        f"|| {_REPORT} AS report FROM means",
        "device_batch_stats": f"WITH {BASE}, stats AS (SELECT DeviceId, {STATS} FROM readings "
        f"GROUP BY DeviceId) SELECT * REPLACE (strftime(latest_time, '{MICROS}') AS latest_time) "
        "FROM stats",
        "cleansed_batch_gauges": f"WITH {BASE}, {CLEAN}, stats AS (SELECT DeviceId, {STATS}, "
        "1.0 AS online FROM cleansed GROUP BY DeviceId) "
        + " UNION ALL ".join(
            f"SELECT '{name}' AS metric, CAST(DeviceId AS VARCHAR) AS device_id, "
            f"CAST({c} AS DOUBLE) AS value FROM stats"
            for c, name in (
                ("online", "fms_device_online"),
                ("sensor1", "fms_sensor1_value"),
                ("sensor2", "fms_sensor2_value"),
                ("sensor3", "fms_sensor3_value"),
                ("motor1", "fms_motor1_rpm"),
                ("motor2", "fms_motor2_rpm"),
                ("motor3", "fms_motor3_rpm"),
                ("fail_rate", "fms_failure_rate"),
            )
        ),
        "data_quality_score": f"WITH {BASE} SELECT DeviceId, count(*) AS readings, "
        f"{_r4(f'100.0 * CAST(count(*) FILTER ({VALID}) AS DOUBLE) / count(*)')} AS quality_score "
        "FROM readings GROUP BY DeviceId",
        "device_coverage": f"WITH {BASE}, {FLEET} SELECT f.DeviceId, count(r.event_id) AS readings, "
        "count(r.event_id) > 0 AS covered FROM fleet f LEFT JOIN readings r USING (DeviceId) "
        "GROUP BY f.DeviceId",
        "missing_devices": f"WITH {BASE}, {FLEET} SELECT DeviceId FROM fleet WHERE DeviceId NOT IN "
        f"(SELECT DeviceId FROM readings WHERE {SLICE})",
        "device_online": f"WITH {BASE}, {FLEET}, seen AS (SELECT DeviceId, max(collected_ts) AS "
        "last_seen FROM readings GROUP BY DeviceId) "
        f"SELECT f.DeviceId, strftime(last_seen, '{MICROS}') AS last_seen, "
        f"CASE WHEN last_seen >= {NOW} - INTERVAL 60 MINUTE THEN 1 ELSE 0 END AS online "
        "FROM fleet f LEFT JOIN seen USING (DeviceId)",
        "device_outages": f"WITH {BASE}, apart AS (SELECT DeviceId, event_ts, collected_ts, event_id, epoch_us(event_ts) - epoch_us(lag(event_ts) "
        f"OVER (PARTITION BY DeviceId ORDER BY {OLDEST})) AS gap FROM readings WHERE event_ts IS NOT NULL AND DeviceId IS NOT NULL), "
        "numbered AS (SELECT *, sum(CASE WHEN gap IS NULL OR gap > 21600000000 THEN 1 ELSE 0 END) OVER "
        f"(PARTITION BY DeviceId ORDER BY {OLDEST} ROWS UNBOUNDED PRECEDING) AS span FROM apart) "
        f"SELECT DeviceId, CAST(span AS BIGINT) AS span, strftime(min(event_ts), '{MICROS}') AS online_from, "
        f"strftime(max(event_ts), '{MICROS}') AS online_to, count(*) AS readings, "
        "max(CASE WHEN gap > 21600000000 THEN gap END) / 1000000 AS silent_seconds FROM numbered GROUP BY DeviceId, span",
        "distinct_partitions": f"WITH {BASE} SELECT DISTINCT CAST(year(event_ts) AS INT) AS year, "
        "CAST(month(event_ts) AS INT) AS month, CAST(day(event_ts) AS INT) AS day, "
        "CAST(hour(event_ts) AS INT) AS hour, DeviceId FROM readings WHERE event_ts IS NOT NULL",
        "valid_range_as_of": f"WITH {BASE} SELECT {SHORT}, CASE WHEN event_ts < TIMESTAMP '2024-01-10' THEN "
        "sensor1 BETWEEN 0 AND 100 AND sensor2 BETWEEN 0 AND 100 AND sensor3 BETWEEN 0 AND 150 AND motor1 BETWEEN 0 AND 2000 "
        "AND motor2 BETWEEN 0 AND 1500 AND motor3 BETWEEN 0 AND 1800 AND DeviceId BETWEEN 1 AND 100 AND isFail IN (TRUE, FALSE) "
        "WHEN event_ts < TIMESTAMP '2024-01-20 12:00:00' THEN sensor1 BETWEEN 0 AND 100 AND sensor2 BETWEEN 0 AND 100 "
        "AND sensor3 BETWEEN 0 AND 100 AND isFail IN (TRUE, FALSE) "
        "WHEN event_ts IS NOT NULL THEN sensor1 BETWEEN 0 AND 100 AND sensor2 BETWEEN 0 AND 100 AND sensor3 BETWEEN 0 AND 150 "
        "AND motor1 BETWEEN 0 AND 2000 AND motor2 BETWEEN 0 AND 1500 AND motor3 BETWEEN 0 AND 1800 AND DeviceId BETWEEN 1 AND 5 "
        "AND isFail IN (TRUE, FALSE) END AS valid FROM readings",
        "partition_inventory": f"WITH {BASE} SELECT DISTINCT DeviceId, ymdh FROM readings "
        "ORDER BY DeviceId, ymdh",
        "partition_reconcile": f"WITH {BASE}, named AS (SELECT DISTINCT 'DeviceId=' || DeviceId || '/ymdh=' || ymdh AS partition, "
        "ymdh FROM readings) SELECT partition, CASE WHEN ymdh >= '2024012000' THEN 'add' ELSE 'drop' END AS action FROM named "
        "WHERE ymdh >= '2024012000' OR ymdh < '2024010200'",
        "outlier_bounds": f"WITH {BASE}, {_bounds()} {_BOUND_ROWS}",
        "outlier_iqr": f"WITH {BASE}, {_bounds()} SELECT {SHORT}, "
        + ", ".join(map(_iqr_flag, METRICS))
        + " FROM readings, cuts",
        "outlier_zscore": f"WITH {BASE}, m AS (SELECT {_MOMENTS} FROM readings) "
        f"SELECT {SHORT}, {_Z_FLAGS} FROM readings, m",
        "outlier_rolling": f"WITH {BASE}, rolled AS (SELECT {SHORT}, {LIST}, {_ROLLING} "
        "FROM readings WHERE event_ts IS NOT NULL WINDOW w AS (PARTITION BY DeviceId "
        f"ORDER BY {OLDEST} ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)) SELECT {SHORT}, "
        + ", ".join(map(_iqr_flag, METRICS))
        + f" FROM rolled UNION ALL SELECT {SHORT}, {_NO_FLAGS} FROM readings WHERE event_ts IS NULL",
        "fill_previous": _fill("UNBOUNDED PRECEDING AND 1 PRECEDING"),
        "fill_previous_one_step": _fill("1 PRECEDING AND 1 PRECEDING"),
        "metric_snapshot": _snapshot(False),
        "metric_snapshot_recent": _snapshot(True),
        "panel_series": f"WITH {BASE}, shown AS (SELECT DeviceId, strftime(event_ts, '{MICROS}') AS "
        f"event_ts, {LIST} FROM readings WHERE regexp_full_match(CAST(DeviceId AS VARCHAR), "
        "'[1-9][0-9]?') AND event_ts >= (SELECT max(event_ts) FROM readings) - INTERVAL 24 HOUR) "
        + _long("shown", "DeviceId, event_ts"),
        "panel_series_1m": f"WITH {BASE}, timed AS (SELECT *, strftime(date_trunc('minute', "
        "event_ts), '%Y-%m-%d %H:%M:%S') AS sampled_at FROM readings WHERE event_ts IS NOT NULL) "
        + _newest_known("DeviceId, sampled_at"),
        "panel_scraped": f"WITH {BASE}, placed AS (SELECT *, row_number() OVER (PARTITION BY DeviceId, event_ts ORDER BY collected_ts DESC, "
        "event_id DESC) AS rn FROM readings WHERE event_ts IS NOT NULL AND DeviceId IS NOT NULL), newest AS (SELECT * FROM placed WHERE rn = 1), "
        "grid AS (SELECT DISTINCT DeviceId, date_trunc('minute', event_ts) + to_minutes(CAST(m AS INT)) AS at FROM newest, range(0, 6) t(m)), "
        "shown AS (SELECT g.DeviceId, strftime(g.at, '%Y-%m-%d %H:%M:%S') AS sampled_at, "
        f"{LIST} FROM grid g ASOF JOIN newest n ON g.DeviceId = n.DeviceId AND g.at >= n.event_ts "
        "WHERE g.at < n.event_ts + INTERVAL 5 MINUTE) " + _long("shown", "DeviceId, sampled_at"),
        "panel_legend": f"WITH {BASE}, timed AS (SELECT * FROM readings WHERE event_ts IS NOT NULL) "
        f"SELECT DeviceId, metric, value AS last_value FROM ({_newest_known('DeviceId')})",
        "threshold_state": f"WITH {BASE}, long AS ({_long('readings', SHORT)}) SELECT {SHORT}, "
        f"metric, value, CASE WHEN value < 0 OR value >= CASE metric {_LIMITS} END THEN 'red' "
        "ELSE 'green' END AS state FROM long",
        "device_labels": f"WITH {BASE} SELECT DISTINCT CAST(DeviceId AS VARCHAR) AS device_id "
        "FROM readings ORDER BY device_id",
    }
    routed = (
        f"WITH {BASE} SELECT event_id, CASE WHEN event_ts IS NULL THEN 'reject' ELSE {ROUTE} END "
        f"AS route, DeviceId, time, {LIST}, isFail FROM (SELECT *, CASE WHEN event_ts IS NULL "
        "THEN 1 ELSE row_number() OVER (PARTITION BY event_ts, DeviceId ORDER BY collected_ts) "
        "END AS rn FROM readings) WHERE rn = 1"
    )
    sql["stream_routes"] = sql["stream_route_batches"] = routed
    sql["stream_dedup_exact"] = f"SELECT * EXCLUDE (route) FROM ({routed})"
    sql["stream_latest"] = sql["latest_raw"]
    sql["stream_hourly_mean"] = (
        f"WITH {BASE} SELECT DeviceId, ymdh, "
        + ", ".join(f"{_r4(f'avg({m})')} AS {m}_avg" for m in METRICS)
        + " FROM readings GROUP BY DeviceId, ymdh, date_trunc('hour', collected_ts) "
        "HAVING date_trunc('hour', collected_ts) + INTERVAL 1 HOUR "
        f"<= {NOW} - INTERVAL 10 MINUTE"
    )
    sql["stream_hourly_mean_corrected"] = sql["hourly_device_mean"]
    sql["stream_online_edges"] = (
        f"WITH {BASE}, apart AS (SELECT DeviceId, event_ts, epoch_us(event_ts) - epoch_us(lag(event_ts) OVER "
        f"(PARTITION BY DeviceId ORDER BY {OLDEST})) AS gap, epoch_us(lead(event_ts) OVER (PARTITION BY DeviceId ORDER BY {OLDEST})) "
        "- epoch_us(event_ts) AS ahead FROM readings WHERE event_ts IS NOT NULL AND DeviceId IS NOT NULL), "
        "edges AS (SELECT DeviceId, event_ts AS moment, 1 AS online FROM apart WHERE gap IS NULL OR gap > 21600000000 "
        "UNION ALL SELECT DeviceId, event_ts + INTERVAL 6 HOUR, 0 FROM apart WHERE ahead > 21600000000 OR (ahead IS NULL "
        "AND event_ts + INTERVAL 6 HOUR < (SELECT max(event_ts) FROM readings) - INTERVAL 10 MINUTE)) "
        f"SELECT DeviceId, strftime(moment, '{MICROS}') AS changed_at, online FROM edges"
    )
    sql["stream_outlier_sketches"] = f"WITH {BASE} " + " UNION ALL ".join(
        f"SELECT '{m}' AS metric, count({m}) AS readings, {_r4(f'min({m})')} AS lowest, {_r4(f'max({m})')} AS highest, "
        "'true' AS q1_near, 'true' AS q3_near FROM readings"
        for m in METRICS
    )
    sql["stream_rules"] = sql["cleansed_batch_gauges"]
    sql["stream_fill_previous"] = sql["fill_previous"]
    sql["stream_landing"] = f"WITH {BASE} SELECT {', '.join(READING_COLUMNS)} FROM readings"
    for route in FAMILY_OF_ROUTE:
        sql[f"route_{route}"] = _row(ROUTE_FILTER[route])
        sql[f"latest_{route}"] = _latest(ROUTE_FILTER[route])
    return sql


# Columns that leave as text because they may be NULL.
_TEXT = {
    "valid_range_flag": ("valid",),
    "valid_range_as_of": ("valid",),
    "validate_types": ("isFail", "DeviceId"),
    "device_outages": ("silent_seconds",),
    "derive_time": ("year", "month", "day", "hour"),
    "stream_landing": ("isFail",),
    "stream_fill_previous": ("isFail",),
    "stream_routes": ("isFail",),
    "stream_dedup_exact": ("isFail",),
    "stream_route_batches": ("isFail",),
    **dict.fromkeys(
        ("parse_json", "reject_null_keys", "alerts", "ingest_gate", "handle_nulls", "cleanse",
         "dedup_readings", "fill_previous", "fill_previous_one_step", "route_data",
         "route_dataerr", "route_fail"),
        ("isFail",),
    ),
}


def statements() -> dict[str, str]:
    sql = _build()
    for name, columns in _TEXT.items():
        shown = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in columns)
        sql[name] = f"SELECT * REPLACE ({shown}) FROM ({sql[name]})"
    return sql
