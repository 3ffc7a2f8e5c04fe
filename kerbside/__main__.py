"""``python -m kerbside JOB --servers … --topic … --out … --checkpoints …``"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from kerbside.session import build_session
from kerbside.sources import snapshots
from kerbside.sources.stream import SourceConfig, pass_stream
from kerbside.streaming import apps, jobs, sinks


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="kerbside", description="Run one of the streaming jobs.")
    parser.add_argument("job", choices=["archive", "flow", "alerts", "overspeed"])
    parser.add_argument("--servers", required=True, help="kafka bootstrap servers")
    parser.add_argument("--topic", required=True, help="topic of the passes")
    parser.add_argument("--out", required=True, help="folder of the tables")
    parser.add_argument("--checkpoints", required=True, help="folder of the checkpoints")
    parser.add_argument("--wire", choices=["protobuf", "json"], default="protobuf")
    parser.add_argument("--max-per-trigger", type=int, help="records per micro-batch")
    parser.add_argument("--trigger", default="1 second")
    parser.add_argument("--table", help="parquet path or jdbc: URL of the watchlist or of the gates")
    parser.add_argument("--option", action="append", default=[], metavar="KEY=VALUE", help="read option of --table")
    parser.add_argument("--order", help="column of --table whose greatest value is the row that counts for a repeated key")
    parser.add_argument("--refresh-seconds", type=float, default=60, help="least time between two reads of --table")
    parser.add_argument("--alarm-topic", help="topic for alarm messages; none are sent without it")
    parser.add_argument("--alarm-wire", choices=["protobuf", "json"], default="protobuf")
    args = parser.parse_args(argv)
    if args.job in ("alerts", "overspeed") and not args.table:
        parser.error(f"{args.job} needs --table")
    return args


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = build_session(f"kerbside-{args.job}")
    payloads = pass_stream(spark, SourceConfig(
        servers=args.servers, topic=args.topic, max_per_trigger=args.max_per_trigger))
    setup = apps.Setup(
        args.out, args.checkpoints, wire=args.wire, trigger=args.trigger, alarm_wire=args.alarm_wire)
    version = jobs.every(args.refresh_seconds)
    options = dict(pair.split("=", 1) for pair in args.option)

    def table():
        return snapshots.read_table(spark, args.table, options)

    if args.job == "archive":
        queries = apps.archive_app(payloads, setup)
    elif args.job == "flow":
        queries = apps.flow_app(payloads, setup)
    elif args.job == "alerts":
        send = None
        if args.alarm_topic:
            def send(messages, batch_id):
                sinks.kafka_writer(messages, args.servers, args.alarm_topic).save()
        order = args.order or "seq"
        queries = apps.alerts_app(payloads, lambda: snapshots.load_watchlist(table(), order), setup, send, version)
    else:
        queries = apps.overspeed_app(payloads, lambda: snapshots.load_gates(table(), args.order), setup, version)
    wait(spark, queries)


def wait(spark: SparkSession, queries: list[StreamingQuery]) -> None:
    """Until one query ends; the others are then stopped, and a failure is passed on."""
    try:
        spark.streams.awaitAnyTermination()
    finally:
        for query in queries:
            query.stop()


if __name__ == "__main__":
    main()
