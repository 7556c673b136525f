"""Time parsing and the keys derived from it.

ANSI mode stays on, so text is always parsed with the ``try_`` functions: a bad
value becomes NULL instead of failing the job.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge.rules import REPORT_UTC_OFFSET_HOURS, RETENTION_MINUTES

HOUR_KEY = "yyyyMMddHH"


def parse_time(column: str) -> Column:
    return F.try_to_timestamp(F.col(column))


def hour_key(ts: Column) -> Column:
    """``yyyyMMddHH``: sorts as text and needs no escaping as a folder name."""
    return F.date_format(ts, HOUR_KEY)


def with_times(df: DataFrame) -> DataFrame:
    """Add ``event_ts`` (from ``time``) and ``collected_ts`` (from ``collected_at``)."""
    return df.withColumns(
        {"event_ts": parse_time("time"), "collected_ts": parse_time("collected_at")}
    )


def with_hour_key(df: DataFrame, source: str = "collected_ts") -> DataFrame:
    """Add ``ymdh``; the routers key on collection time, the newest one on event time."""
    return df.withColumn("ymdh", hour_key(F.col(source)))


def with_calendar(df: DataFrame, source: str = "event_ts") -> DataFrame:
    ts = F.col(source)
    return df.withColumns(
        {
            "year": F.year(ts),
            "month": F.month(ts),
            "day": F.dayofmonth(ts),
            "hour": F.hour(ts),
        }
    )


def path_key(ts: Column, device: Column) -> Column:
    """``YYYY/MM/DD/HH/ID``, zero-padded, from each row's own time."""
    return F.concat_ws(
        "/", F.date_format(ts, "yyyy/MM/dd/HH"), F.format_string("%02d", device)
    )


def as_instant(moment: datetime | str | Column) -> Column:
    """A literal or computed point in time as a timestamp column.

    A datetime without a zone is read in the session's zone, UTC, like all text here;
    passed on as it is, it would be read in the zone of the driver's machine.
    """
    if isinstance(moment, Column):
        return moment
    if isinstance(moment, datetime):
        if moment.tzinfo is not None:
            moment = moment.astimezone(timezone.utc)
        moment = moment.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(moment).cast("timestamp")


def hours_touched(as_of: datetime, minutes: int = RETENTION_MINUTES) -> list[str]:
    """Every hour key that the window of ``minutes`` before ``as_of`` overlaps.

    Hours are named in UTC, like the folders. Taking only the current hour would cut the
    window at the top of the hour.
    """
    if as_of.tzinfo is not None:
        as_of = as_of.astimezone(timezone.utc).replace(tzinfo=None)
    hour = (as_of - timedelta(minutes=minutes)).replace(minute=0, second=0, microsecond=0)
    keys = []
    while hour <= as_of:
        keys.append(hour.strftime("%Y%m%d%H"))
        hour += timedelta(hours=1)
    return keys


def check_hour(ymdh: str) -> str:
    if len(ymdh) != 10 or not ymdh.isdigit():
        raise ValueError(f"expected an hour as ten digits, such as 2025070906, got {ymdh!r}")
    return ymdh


def default_report_hour(
    now: datetime | None = None, utc_offset_hours: int = REPORT_UTC_OFFSET_HOURS
) -> str:
    """The last full hour on the clock of the report's zone."""
    now = now or datetime.now(timezone.utc)
    if now.tzinfo is None:
        now = now.replace(tzinfo=timezone.utc)
    local = now.astimezone(timezone(timedelta(hours=utc_offset_hours)))
    return (local - timedelta(hours=1)).strftime("%Y%m%d%H")
