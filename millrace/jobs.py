"""Command line of the long-running jobs, for spark-submit.

    python -m millrace.jobs publish --csv wine.csv --servers broker:9092 --topic wine
    python -m millrace.jobs stream --servers broker:9092 --topic wine --output s3a://lake/wine \\
        --checkpoint s3a://lake/wine-progress
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession

from millrace.operators.manifest import normalize_fields
from millrace.session import build_session
from millrace.sinks.messages import to_messages, write_messages
from millrace.sources.external import read_message_stream
from millrace.sources.files import (
    INPUT_ORDER,
    detect_delimiter,
    read_text_csv,
    with_input_order,
)
from millrace.sources.schemas import WINE_FIELDS
from millrace.streaming.messages import replay
from millrace.streaming.pipeline import DatabaseSinks, FileSinks, start_stream


def publish(spark: SparkSession, args: argparse.Namespace) -> None:
    """Send a wine file as numbered messages, in file order and once per round."""
    text = read_text_csv(spark, args.csv, delimiter=detect_delimiter(spark, args.csv))
    rows = normalize_fields(with_input_order(text), WINE_FIELDS, keep=tuple(INPUT_ORDER))
    messages = to_messages(rows, INPUT_ORDER, drop_order=True)
    write_messages(
        replay(messages, args.rounds).drop("round"),
        args.format,
        servers=args.servers,
        topic=args.topic,
        path=args.path,
    )


def stream(spark: SparkSession, args: argparse.Namespace) -> None:
    """Process messages until stopped, or until all present ones are done."""
    messages = read_message_stream(
        spark,
        args.format,
        servers=args.servers,
        topic=args.topic,
        path=args.path,
        schema=None if args.format == "kafka" else "key string, value string, timestamp timestamp",
    )
    sinks = FileSinks(args.output)
    if args.jdbc_url:
        tables = {"events": args.events_table, "stats": args.stats_table}
        login = {"user": args.jdbc_user, "password": os.environ.get("JDBC_PASSWORD")}
        properties = {name: value for name, value in login.items() if value}
        sinks = DatabaseSinks(args.jdbc_url, tables, properties, sinks)
    start_stream(
        messages, sinks, args.checkpoint, available_now=args.available_now
    ).awaitTermination()


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="millrace.jobs", description=__doc__)
    jobs = top.add_subparsers(dest="job", required=True)
    sender = jobs.add_parser("publish")
    sender.add_argument("--csv", required=True)
    sender.add_argument("--rounds", type=int, default=1)
    sender.set_defaults(run=publish)
    reader = jobs.add_parser("stream")
    reader.add_argument("--output", required=True)
    reader.add_argument("--checkpoint", required=True)
    reader.add_argument("--available-now", action="store_true")
    reader.add_argument("--jdbc-url", help="send events and statistics to a database")
    reader.add_argument("--jdbc-user", help="its password comes from JDBC_PASSWORD")
    reader.add_argument("--events-table", default="events")
    reader.add_argument("--stats-table", default="quality_stats")
    reader.set_defaults(run=stream)
    for job in (sender, reader):
        job.add_argument("--format", default="kafka")
        job.add_argument("--servers")
        job.add_argument("--topic")
        job.add_argument("--path")
    return top


def main(arguments: list[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    args.run(build_session(f"millrace-{args.job}"), args)


if __name__ == "__main__":
    main()
