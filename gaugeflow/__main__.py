"""Command line for spark-submit: ``python -m gaugeflow <command> --root <folder>``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from gaugeflow import tables
from gaugeflow.branches import MAIN, Branch, clean, publish
from gaugeflow.functions.clock import resolve
from gaugeflow.plans.incremental import KEYED_MODELS, refresh
from gaugeflow.plans.registry import DASHBOARDS, MODELS, run_models
from gaugeflow.session import build_session, shared_dir
from gaugeflow.sources.messages import TOPIC, file_messages, kafka_messages
from gaugeflow.sources.stores import DatasetStore, TableStore, TelemetryStore
from gaugeflow.streaming import ingest, ledger, rollup
from gaugeflow.streaming.triggers import TRIGGER


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="gaugeflow")
    parser.add_argument("--root", help="data folder; default: the session's shared folder")
    parser.add_argument("--branch", default=MAIN)
    parser.add_argument("--catalog", help="catalog of the branch's tables")
    parser.add_argument("--conf", action="append", default=[], metavar="KEY=VALUE")
    commands = parser.add_subparsers(dest="command", required=True)

    create = commands.add_parser("create-tables")
    create.add_argument("--format", default="parquet")
    commands.add_parser("drop-tables")
    commands.add_parser("list-tables")

    stream = commands.add_parser("ingest")
    source = stream.add_mutually_exclusive_group(required=True)
    source.add_argument("--servers", help="Kafka bootstrap servers")
    source.add_argument("--files", help="folder of envelope Parquet files")
    stream.add_argument("--topic", default=TOPIC)
    stream.add_argument("--trigger", default=TRIGGER)
    stream.add_argument("--once", action="store_true", help="work off what is there, then stop")
    stream.add_argument("--sink", choices=("dataset", "tables"), default="dataset")
    stream.add_argument("--min-partitions", type=int, help="least tasks that read the topic")
    stream.add_argument("--max-per-trigger", type=int, help="most offsets or files per batch")
    stream.add_argument("--write-tasks", type=int, help="tasks that write a batch's files")
    stream.add_argument(
        "--fail-on-data-loss", action="store_true", help="stop at offsets the broker has lost"
    )
    stream.add_argument("--rollup", action="store_true", help="also maintain hourly aggregates")

    push = commands.add_parser("publish")
    push.add_argument("--to", help="branch to publish to; default: the branch itself")
    push.add_argument("--since-date")
    push.add_argument("--replace", action="store_true", help="do not merge with what is there")

    tidy = commands.add_parser("clean", help="remove landed batches that are published")
    tidy.add_argument("--to", help="branch they were published to; default: the branch itself")
    tidy.add_argument("--keep", type=int, default=2, help="versions that stay readable")
    merge = commands.add_parser("refresh", help="merge newly landed batches into keyed models")
    merge.add_argument("names", nargs="*", choices=[*KEYED_MODELS, []])
    commands.add_parser("batches", help="what the streams have landed, by batch")

    for name, plans in (("run-models", MODELS), ("query", DASHBOARDS)):
        run = commands.add_parser(name)
        run.add_argument("names", nargs="*", choices=[*plans, []])
        run.add_argument("--as-of-ms", type=int)
        run.add_argument("--source", choices=("published", "landing", "tables"), default="published")
        if name == "query":
            run.add_argument("--output", help="folder for whole results, one below it per query")
            run.add_argument("--rows", type=int, default=100, help="rows to print without --output")
    return parser


def _store(spark: SparkSession, branch: Branch, source: str) -> TelemetryStore:
    if source == "tables":
        return TableStore(spark, branch.namespace)
    return DatasetStore(spark, branch.published if source == "published" else branch.landing)


def _ingest(spark: SparkSession, branch: Branch, args: argparse.Namespace) -> None:
    def messages():
        if args.servers:
            return kafka_messages(
                spark, args.servers, args.topic,
                max_offsets_per_trigger=args.max_per_trigger, min_partitions=args.min_partitions,
                fail_on_data_loss=args.fail_on_data_loss,
            )
        return file_messages(spark, args.files, max_files_per_trigger=args.max_per_trigger)

    trigger = None if args.once else args.trigger
    if args.sink == "tables":
        tables.create_tables(spark, branch.namespace)
        rows = ingest.gate_messages(messages())
        started = [
            ingest.start_table_sink(rows, branch.namespace, branch.checkpoint(), trigger=trigger)
        ]
    else:
        started = [
            ingest.start_dataset_sink(
                ingest.gate_messages(messages()), branch.landing, branch.checkpoint(),
                trigger=trigger, write_tasks=args.write_tasks,
                hours=branch.rollup if args.rollup else None,
            )
        ]
    if args.rollup and args.sink == "tables":
        started.append(
            rollup.start_rollup(
                ingest.gate_messages(messages()), branch.rollup, branch.checkpoint("hourly"),
                trigger=trigger,
            )
        )
    ingest.wait(spark, started)


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = build_session(f"gaugeflow-{args.command}", dict(c.split("=", 1) for c in args.conf))
    branch = Branch(args.root or shared_dir(spark), args.branch, args.catalog)
    if args.command == "create-tables":
        print("\n".join(tables.create_tables(spark, branch.namespace, args.format)))
    elif args.command == "drop-tables":
        tables.drop_tables(spark, branch.namespace)
    elif args.command == "list-tables":
        print("\n".join(tables.list_tables(spark, branch.namespace)))
    elif args.command == "ingest":
        _ingest(spark, branch, args)
    elif args.command == "publish":
        target = Branch(branch.root, args.to, args.catalog) if args.to else branch
        publish(
            spark, branch, target, since_date=args.since_date, replace=args.replace
        )
    elif args.command == "clean":
        target = Branch(branch.root, args.to, args.catalog) if args.to else branch
        print("\n".join(clean(spark, branch, target, keep=args.keep)))
    elif args.command == "refresh":
        for name in args.names or KEYED_MODELS:
            print(name, refresh(spark, branch, name))
    elif args.command == "batches":
        rows = ledger.report(spark, branch.landing)
        rows.orderBy("stream", "batch").show(1000, truncate=False)
    elif args.command == "run-models":
        store = _store(spark, branch, args.source)
        print("\n".join(run_models(spark, store, as_of_ms=args.as_of_ms, names=args.names or None)))
    elif args.command == "query":
        store = _store(spark, branch, args.source)
        as_of = resolve(args.as_of_ms)
        for name in args.names or DASHBOARDS:
            rows = DASHBOARDS[name](store, as_of)
            if args.output:
                rows.write.mode("overwrite").parquet(f"{args.output}/{name}")
                continue
            print(name)
            rows.show(args.rows, truncate=False)


if __name__ == "__main__":
    main()
