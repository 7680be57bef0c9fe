"""Entry points for spark-submit: ``python -m tickmart.cli COMMAND --root FOLDER [options]``.

The batch commands run once. ``stream`` starts the outputs of one message feed and waits for them; with ``--once`` it
takes what is there and ends.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys
from collections.abc import Sequence

from pyspark.sql import SparkSession

from tickmart.plans import jobs
from tickmart.session import builder
from tickmart.sinks.stores import document_sink, jdbc_sink, parquet_sink
from tickmart.streaming import app, feeds

STREAM_SINKS = {"json": feeds.json_sink, "store": feeds.upsert_sink}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tickmart")
    top.add_argument("--root", required=True, help="folder of the installation, on storage that all executors share")
    commands = top.add_subparsers(dest="command", required=True)
    clean = commands.add_parser("clean", help="raw to clean, what arrived since the last run")
    clean.add_argument("--now", type=dt.datetime.fromisoformat, help="later ticks wait")
    commands.add_parser("aggregate", help="clean to daily, weekly, monthly, the touched days")
    commands.add_parser("serve", help="snapshot, history, alerts and volume baseline, the touched days")
    export = commands.add_parser("export", help="metric and serving tables to the stores")
    export.add_argument("--documents", help="folder of the document stores")
    export.add_argument("--tables", help="folder of relational tables as files")
    export.add_argument("--jdbc", help="URL of a database")
    export.add_argument("--jdbc-properties", type=json.loads, default={}, help="JSON object")
    retain = commands.add_parser("retain", help="remove expired dates of the clean table")
    retain.add_argument("--as-of", type=dt.date.fromisoformat, required=True)
    retain.add_argument("--days", type=int, default=30)
    retain.add_argument("--delete", action="store_true", help="without it expired dates are only listed")
    reset = commands.add_parser("reset", help="do everything from a day again")
    reset.add_argument("--date", type=dt.date.fromisoformat, default=jobs.RESET_DATE)
    for name in ("land", "stream"):
        stream = commands.add_parser(name, help="messages to landing folders" if name == "land" else "messages to the stream outputs")
        feed = stream.add_mutually_exclusive_group(required=True)
        feed.add_argument("--files", help="folder of text files, one message per line")
        feed.add_argument("--kafka", help="bootstrap servers")
        stream.add_argument("--topic", default=feeds.RAW_TOPIC)
        stream.add_argument("--tolerate-data-loss", action="store_true")
        stream.add_argument("--once", action="store_true")
        if name == "stream":
            stream.add_argument("--output", action="append", required=True, metavar="NAME=json|store|console|topic:NAME",
                                help=f"one of {', '.join(app.OUTPUTS)} and where it goes")
    return top


def _messages(spark: SparkSession, args: argparse.Namespace):
    if args.files:
        return feeds.file_feed(spark, args.files)
    return feeds.kafka_feed(spark, args.kafka, args.topic, fail_on_data_loss=not args.tolerate_data_loss)


def _streams(spark: SparkSession, layout: jobs.Layout, args: argparse.Namespace) -> list:
    trigger = {"availableNow": True} if args.once else None
    messages = _messages(spark, args)
    if args.command == "land":
        return [app.land_raw(messages, layout.raw, f"{args.root}/streams/land", trigger)]
    sinks, as_json = {}, []
    for text in args.output:
        name, _, kind = text.partition("=")
        if name not in app.OUTPUTS:
            raise SystemExit(f"unknown output {name}; there are {', '.join(app.OUTPUTS)}")
        if kind.startswith("topic:"):
            sinks[name] = feeds.kafka_sink(args.kafka, kind[6:])
            as_json.append(name)
        elif kind == "console":
            sinks[name] = feeds.console_sink()
        elif kind in STREAM_SINKS:
            sinks[name] = STREAM_SINKS[kind](f"{args.root}/outputs/{name}")
        else:
            raise SystemExit(f"unknown sink {kind} of {name}")
    baseline = jobs.serving_table(spark, layout, "volume_baseline") if "whale" in sinks else None
    return app.run_outputs(messages, sinks, f"{args.root}/streams", trigger, tuple(as_json), baseline)


def run(spark: SparkSession, argv: Sequence[str]) -> object:
    """Run one command on a session; returns what the job returns."""
    args = parser().parse_args(argv)
    layout = jobs.Layout(args.root)
    if args.command == "clean":
        return jobs.clean_job(spark, layout, args.now)
    if args.command == "aggregate":
        return jobs.aggregate_job(spark, layout)
    if args.command == "serve":
        return jobs.serve_job(spark, layout)
    if args.command == "export":
        relational = jdbc_sink(args.jdbc, args.jdbc_properties) if args.jdbc else parquet_sink(args.tables) if args.tables else None
        return jobs.export_job(spark, layout, relational, document_sink(spark, args.documents) if args.documents else None)
    if args.command == "retain":
        return jobs.retain_job(spark, layout.clean, args.as_of, args.days, dry_run=not args.delete)
    if args.command == "reset":
        return jobs.reset_job(spark, layout, args.date)
    queries = _streams(spark, layout, args)
    if args.once:
        for query in queries:
            query.awaitTermination()
        return None
    return app.await_any(queries)


def main(argv: Sequence[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = builder(f"tickmart-{args.command}").getOrCreate()
    print(run(spark, argv if argv is not None else sys.argv[1:]))
    spark.stop()


if __name__ == "__main__":
    main()
