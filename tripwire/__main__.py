"""Command-line entry for spark-submit:

    spark-submit -m tripwire stream    --servers HOST:9092 --topic transactions --output s3://.../pipeline
    spark-submit -m tripwire stream    --source-dir /data/payloads --output /data/pipeline --available-now
    spark-submit -m tripwire reconcile --output /data/pipeline --reports /data/reports [--hours 6]
    spark-submit -m tripwire report    --output /data/pipeline --reports /data/reports [--hours 24]

``--output`` is the speed layer's base path (``fraud/``, ``validated/``,
``checkpoints/``); the batch jobs read the tables the stream wrote.
"""

from __future__ import annotations

import argparse
import os
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from tripwire.config import (HIGH_VALUE_THRESHOLD, RECONCILIATION_LOOKBACK_HOURS, REPORT_LOOKBACK_HOURS,
                             WATERMARK_DELAY)
from tripwire.session import pin_session
from tripwire.sources.scans import as_of_text


def _session(app: str) -> SparkSession:
    return pin_session(SparkSession.builder.appName(app).getOrCreate())


def _now() -> str:
    return datetime.now(timezone.utc).replace(tzinfo=None).isoformat(sep=" ")


def _as_of(text: str | None, events) -> str:
    """The look-back reference time as ISO text in UTC: now, a given time, or the
    newest event time of ``events`` (one aggregate value, fetched as text so that
    no local zone takes part)."""
    if text is None:
        return _now()
    if text == "latest":
        from pyspark.sql import functions as F

        return events.agg(F.max("timestamp").cast("string")).first()[0] or _now()
    return as_of_text(datetime.fromisoformat(text))


def _database(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("--jdbc-table", default="fraud_transactions")
    parser.add_argument("--jdbc-property", action="append", default=[], metavar="NAME=VALUE",
                        help="user, driver and the like; NAME=@VARIABLE takes the value from the environment")


def _properties(given: list[str]) -> dict[str, str]:
    pairs = (text.split("=", 1) for text in given)
    return {name: os.environ[value[1:]] if value.startswith("@") else value for name, value in pairs}


def _jdbc(spark: SparkSession, args: argparse.Namespace, now: str):
    from tripwire.sources.scans import fraud_jdbc_scan

    return fraud_jdbc_scan(spark, args.jdbc_url, table=args.jdbc_table, hours=args.hours, as_of=now,
                           properties=_properties(args.jdbc_property))


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="tripwire")
    sub = ap.add_subparsers(dest="cmd", required=True)
    s = sub.add_parser("stream", help="speed layer: detect fraud, write fraud table and validated files")
    s.add_argument("--servers")
    s.add_argument("--topic", default="transactions")
    s.add_argument("--source-dir", help="JSON payload files instead of a topic")
    s.add_argument("--output", required=True)
    s.add_argument("--threshold", type=float, default=HIGH_VALUE_THRESHOLD)
    s.add_argument("--watermark", default=WATERMARK_DELAY)
    s.add_argument("--one-query", action="store_true", help="one query feeding all sinks (late rows kept)")
    s.add_argument("--filters", action="store_true",
                   help="Bloom filters of stored fraud rows (a table written without: sinks.fraud_table.add_filters first)")
    s.add_argument("--jdbc-url", help="also append fraud rows to a database")
    _database(s)
    s.add_argument("--available-now", action="store_true", help="drain what is there, then stop")
    r = sub.add_parser("reconcile", help="batch layer: reconciliation report, table row, pattern table")
    r.add_argument("--output", required=True)
    r.add_argument("--reports", required=True)
    r.add_argument("--hours", type=int, default=RECONCILIATION_LOOKBACK_HOURS)
    r.add_argument("--incremental", action="store_true", help="sum only what --one-query wrote since the last run")
    r.add_argument("--jdbc-url", help="read the fraud rows from a database instead of the stored table")
    _database(r)
    r.add_argument("--as-of", default=None,
                   help="look-back reference time: ISO text, or 'latest' (newest event time); default now")
    p = sub.add_parser("report", help="analytics report tables")
    p.add_argument("--output", required=True)
    p.add_argument("--reports", required=True)
    p.add_argument("--hours", type=int, default=REPORT_LOOKBACK_HOURS)
    p.add_argument("--jdbc-url", help="read the fraud rows from a database instead of the stored table")
    _database(p)
    p.add_argument("--as-of", default=None,
                   help="look-back reference time: ISO text, or 'latest' (newest event time); default now")
    args = ap.parse_args(argv)
    base = args.output.rstrip("/")

    if args.cmd == "stream":
        from tripwire.streaming.ingest import kafka_transactions, payload_transactions
        from tripwire.sinks.fraud_table import FraudTableWriter
        from tripwire.streaming.run import run_pipeline
        from tripwire.streaming.speed_layer import start_speed_layer

        spark = _session("tripwire-stream")
        if args.source_dir:
            tx = payload_transactions(spark, args.source_dir)
        elif args.servers:
            tx = kafka_transactions(spark, args.servers, args.topic)
        else:
            ap.error("stream needs --servers or --source-dir")
        database = {"jdbc_url": args.jdbc_url, "jdbc_table": args.jdbc_table, "jdbc_properties": _properties(args.jdbc_property)}
        if args.one_query:
            writer = FraudTableWriter(f"{base}/fraud", quarantine_path=f"{base}/fraud_quarantine",
                                      filter_path=f"{base}/fraud_filters" if args.filters else None, **database)
            queries = [start_speed_layer(tx, base, available_now=args.available_now, threshold=args.threshold,
                                         delay=args.watermark, writer=writer)]
        else:
            queries = run_pipeline(spark, tx, base, available_now=args.available_now, threshold=args.threshold,
                                   watermark=args.watermark, filters=args.filters, **database)
        if args.available_now:
            for q in queries:
                q.awaitTermination()
        else:
            spark.streams.awaitAnyTermination()
        return 0

    from tripwire.plans.jobs import reconciliation_job, report_job
    from tripwire.operators.increments import advance, merged_totals, partial_sums
    from tripwire.sinks.fraud_table import read_fraud_table
    from tripwire.sources.scans import validated_scan

    if args.cmd == "reconcile":
        spark = _session("tripwire-reconcile")
        summed, validated = None, validated_scan(spark, f"{base}/validated", written_by_stream=not args.incremental)
        now = _as_of(args.as_of, validated)
        if args.incremental:
            advance(spark, base, f"{base}/validated_sums")
            summed = merged_totals(partial_sums(spark, f"{base}/validated_sums"))
        fraud = (_jdbc(spark, args, now) if args.jdbc_url else read_fraud_table(spark, f"{base}/fraud"))
        out = reconciliation_job(spark, validated, fraud, args.reports, now, hours=args.hours,
                                 table_path=f"{base}/reconciliation_reports", summed=summed)
    else:
        spark = _session("tripwire-report")
        fraud = read_fraud_table(spark, f"{base}/fraud")
        now = _as_of(args.as_of, fraud)
        if args.jdbc_url:
            fraud = _jdbc(spark, args, now)
        out = report_job(spark, fraud, args.reports, now=now, hours=args.hours)
    for name, path in out.items():
        print(f"{name}\t{path or '(no rows)'}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
