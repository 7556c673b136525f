"""Command-line jobs: ``spark-submit ... -m fleetgauge.jobs <job>`` or ``python -m``.

Streaming jobs run until stopped, or once over what is there with ``--once``.
"""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from fleetgauge.functions.messages import malformed, parse_messages, with_reject_text
from fleetgauge.functions.timeparts import check_hour, default_report_hour, hours_touched
from fleetgauge.operators.metrics import metric_snapshot
from fleetgauge.operators.rollup import hourly_device_mean, hourly_device_report
from fleetgauge.rules import RETENTION_MINUTES
from fleetgauge.session import build_session
from fleetgauge.sinks import tables
from fleetgauge.sinks.catalogue import reconcile
from fleetgauge.sources.bus import bus_stream
from fleetgauge.sources.files import routed_hours, staged_hours, text_stream
from fleetgauge.streaming import queries
from fleetgauge.streaming.transforms import DELAY, route_stream


def _source(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """Parsed readings from the bus, or from landed JSON lines, unreadable ones included."""
    if args.brokers:
        lines = bus_stream(spark, args.brokers, args.topic, args.starting, args.max_offsets)
    else:
        lines = text_stream(spark, args.input, args.files_per_trigger)
    return with_reject_text(parse_messages(lines))


def _every(args: argparse.Namespace, usual: str) -> str | None:
    return None if args.once else (args.every or usual)


def land(spark: SparkSession, args: argparse.Namespace) -> None:
    """Bus payloads to JSON lines, and those that are no JSON objects to a place of their own as well."""
    bus = bus_stream(spark, args.brokers, args.topic, args.starting, args.max_offsets)
    queries.await_all(start_landing(bus, args))


def start_landing(bus: DataFrame, args: argparse.Namespace) -> list[StreamingQuery]:
    every = _every(args, queries.TRIGGERS["landing"])
    started = [queries.land_lines(bus, args.out, args.checkpoint, every=every)]
    if args.rejects:
        broken = malformed(parse_messages(bus))
        every = _every(args, queries.TRIGGERS["alerts"])
        started.append(queries.to_files(broken, args.rejects, f"{args.checkpoint}-rejects", "json", every=every))
    return started


def rejects(spark: SparkSession, args: argparse.Namespace) -> None:
    """Bus payloads that are not JSON objects, as they came."""
    bus = bus_stream(spark, args.brokers, args.topic, args.starting, args.max_offsets)
    broken = malformed(parse_messages(bus))
    every = _every(args, queries.TRIGGERS["alerts"])
    queries.to_files(broken, args.out, args.checkpoint, "json", every=every).awaitTermination()


def route(spark: SparkSession, args: argparse.Namespace) -> None:
    """Readings to the routed staging table, deduplicated."""
    routed = route_stream(_source(spark, args), args.delay, hour_source=f"{args.hour_from}_ts")
    every = _every(args, queries.TRIGGERS["routed"])
    queries.route_in_batches(routed, args.out, args.checkpoint, every=every).awaitTermination()


def rules(spark: SparkSession, args: argparse.Namespace) -> None:
    """Readings through the cleansing rules to archive, alerts, cleansed table and gauges."""
    every = _every(args, queries.TRIGGERS["raw"])
    queries.run_rules(_source(spark, args), args.out, args.checkpoint, every=every).awaitTermination()


def compact(spark: SparkSession, args: argparse.Namespace) -> None:
    """Closed hours of the staging table to the routed table."""
    tables.compact_hours(staged_hours(spark, args.input, args.hours), args.out, args.hours)


def snapshot(spark: SparkSession, args: argparse.Namespace) -> None:
    """Latest gauges of all families from the routed table."""
    as_of = args.as_of or datetime.now(timezone.utc).replace(tzinfo=None)
    readings = routed_hours(spark, args.input, hours_touched(as_of, args.minutes))
    gauges = metric_snapshot(readings, as_of=as_of, minutes=args.minutes)
    write = tables.write_exposition if args.text else tables.write_snapshot
    if args.keep_last:
        if not tables.write_if_any(gauges, lambda rows: write(rows, args.out)):
            print("no reading in the span: the last snapshot stays")
    else:
        write(gauges, args.out)


def report(spark: SparkSession, args: argparse.Namespace) -> None:
    """Hourly text reports, for the given hour or the last full one."""
    hour = check_hour(args.hour or default_report_hour(utc_offset_hours=args.utc_offset))
    readings = routed_hours(spark, args.input, [hour], ["data"])
    means = hourly_device_mean(readings)
    devices = means.count()
    if not devices:
        raise SystemExit(f"no device reported in hour {hour}")
    tables.write_reports(hourly_device_report(means), args.out)
    print(f"{devices} devices reported in hour {hour}")


def register(spark: SparkSession, args: argparse.Namespace) -> None:
    """Register the partition folders of a table already declared, and drop those that are gone."""
    if args.input:
        changed = reconcile(spark, args.table, args.input, args.layout)
        print(f"{changed['add']} partitions added, {changed['drop']} dropped")
    else:
        tables.recover_partitions(spark, args.table)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="fleetgauge", description=__doc__)
    jobs = parser.add_subparsers(required=True)

    def job(run, *groups: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(run.__name__, help=run.__doc__)
        sub.set_defaults(run=run)
        if "bus" in groups:
            sub.add_argument("--brokers", required="files" not in groups)
            sub.add_argument("--topic")
            sub.add_argument("--starting", default="earliest", help="offset that a new checkpoint starts at")
            sub.add_argument("--max-offsets", type=int, help="messages of a micro-batch")
        if "files" in groups:
            sub.add_argument("--input")
            sub.add_argument("--files-per-trigger", type=int)
        if "stream" in groups:
            sub.add_argument("--checkpoint", required=True)
            sub.add_argument("--every")
            sub.add_argument("--once", action="store_true")
        if "table" in groups:
            sub.add_argument("--input", required=True)
        if "register" not in groups:
            sub.add_argument("--out", required=True)
        return sub

    job(land, "bus", "stream").add_argument("--rejects", help="where payloads that cannot be read go, too")
    job(rejects, "bus", "stream")
    router = job(route, "bus", "files", "stream")
    router.add_argument("--hour-from", choices=("collected", "event"), default="collected")
    router.add_argument("--delay", default=DELAY, help="copies that arrive within it count once")
    job(rules, "bus", "files", "stream")
    job(compact, "table").add_argument("--hours", nargs="+", required=True)
    gauges = job(snapshot, "table")
    gauges.add_argument("--as-of", type=datetime.fromisoformat)
    gauges.add_argument("--minutes", type=int, default=RETENTION_MINUTES)
    gauges.add_argument("--text", action="store_true")
    gauges.add_argument("--keep-last", action="store_true", help="where there is no reading at all, leave the last snapshot")
    reports = job(report, "table")
    reports.add_argument("--hour")
    reports.add_argument("--utc-offset", type=int, default=0, help="of the clock that the table's hours are named by")
    registered = job(register, "register")
    registered.add_argument("--table", required=True)
    registered.add_argument("--input", help="the table's folder; with it, partitions without a folder are dropped")
    registered.add_argument("--layout", nargs="+", default=list(tables.LAYOUT))
    return parser


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = _parser().parse_args(argv)
    args.run(spark or build_session(f"fleetgauge-{args.run.__name__}"), args)


if __name__ == "__main__":
    main()
