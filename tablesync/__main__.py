"""Entry points for ``spark-submit``: ``stream``, ``batch`` and ``compact``.

The settings folder holds the datasets ``sync_jobs``, ``meta_import``,
``meta_connections`` and ``definitions`` and the file ``masking.properties``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tablesync.operators.backfill import UNREGISTERED, predicate_sql
from tablesync.plans.batch_sync import batch_sync
from tablesync.plans.job import Metadata, SyncJob, create_missing_targets, load_mask_rules, prepare_job
from tablesync.sources.change_events import read_change_events
from tablesync.sources.jdbc import key_ranges, quoted, read_jdbc, with_server_time_zone
from tablesync.sources.kafka import read_kafka, start_options
from tablesync.streaming.sync import SyncOptions, compact_tables, sync_stream


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tablesync")
    commands = parser.add_subparsers(dest="command", required=True)

    stream = commands.add_parser("stream", help="apply a change stream to the targets of a database")
    stream.add_argument("--db", required=True)
    stream.add_argument("--jobName", required=True)
    stream.add_argument("--maskMode", default="unmask", choices=["mask", "unmask"])
    place = stream.add_mutually_exclusive_group(required=True)
    place.add_argument("--events", help="folder of event files")
    place.add_argument("--kafka", help="bootstrap servers")
    stream.add_argument("--topics", nargs="*", default=[])
    stream.add_argument("--start", default="latest", help="latest, earliest or epoch milliseconds; kept over restarts")
    stream.add_argument("--on-unknown", default="quarantine", choices=["quarantine", "fail", "ignore"])
    stream.add_argument("--max-files", type=int, default=1000, help="event files of one batch")
    stream.add_argument("--max-offsets", type=int, default=5_000_000, help="Kafka records of one batch")
    stream.add_argument("--available-now", action="store_true")

    batch = commands.add_parser("batch", help="back-fill the targets of a database since a time")
    batch.add_argument("maskMode", choices=["mask", "unmask"])
    batch.add_argument("db")
    batch.add_argument("date", help="yyyy-MM-dd")
    batch.add_argument("time", help="HH:mm:ss")
    batch.add_argument("--jdbc-option", action="append", default=[], help="key=value for Spark's JDBC reader")
    batch.add_argument("--partitions", type=int, help="parts of a scan; the job's parallelism if not given")
    batch.add_argument("--ranges", type=int, default=1, help="key ranges of a table that are applied one by one")
    batch.add_argument("--run", type=int, help="number of a run that failed, to go on after its last applied range")
    batch.add_argument("--on-error", default="stop", choices=["stop", "continue"])

    compact = commands.add_parser("compact", help="compact the targets of a database, beside its stream")
    compact.add_argument("--db", required=True)
    compact.add_argument("--full", action="store_true", help="write a new base even for a small log")

    for command in (stream, batch, compact):
        command.add_argument("--table-prefix", help="name targets by this prefix and the table")
        command.add_argument("--settings", required=True, help="folder of the metadata tables")
        command.add_argument("--root", required=True, help="folder of the targets")
        command.add_argument("--format", default="json", help="file format of the metadata tables")
    return parser.parse_args(argv)


def load(spark: SparkSession, args: argparse.Namespace) -> SyncJob:
    """The job of a command; its parallelism is that of the shuffles where the session has less."""
    metadata = Metadata.load(spark, args.settings, args.format)
    job = prepare_job(spark, metadata, args.db, table_prefix=args.table_prefix)
    present = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set("spark.sql.shuffle.partitions", max(present, job.settings.parallelism))
    return job


def run_stream(spark: SparkSession, args: argparse.Namespace):
    job = load(spark, args)
    rules = load_mask_rules(spark, args.maskMode, f"{args.settings}/masking.properties")
    create_missing_targets(spark, job.specs, args.root)
    if args.kafka:
        # The records' time may be a little later than the events', which are asked for theirs as well.
        records = read_kafka(spark, args.kafka, args.topics, maxOffsetsPerTrigger=args.max_offsets, **start_options(args.start))
        # A null value only tells Kafka to forget a key; the delete came as an event before it.
        events = records.select(F.col("value").cast("string").alias("value")).where(F.col("value").isNotNull())
    else:
        events = read_change_events(spark, args.events, streaming=True, max_files_per_batch=args.max_files)
    options = SyncOptions(
        label=job.settings.label_prefix or args.jobName,
        db=args.db,
        rules=rules,
        start="earliest" if args.kafka and args.start == "latest" else args.start,
        on_unknown=args.on_unknown,
    )
    trigger = {"availableNow": True} if args.available_now else job.settings.trigger
    checkpoint = f"{args.root}/_checkpoints/{args.db}"
    return sync_stream(events, job.specs, args.root, checkpoint, options, trigger)


def run_batch(spark: SparkSession, args: argparse.Namespace):
    job = load(spark, args)
    rules = load_mask_rules(spark, args.maskMode, f"{args.settings}/masking.properties")
    create_missing_targets(spark, job.specs, args.root)
    options = dict(o.split("=", 1) for o in args.jdbc_option)
    since = f"{args.date} {args.time}"

    rest = {k: v for k, v in options.items() if k != "url"}
    partitions = args.partitions or job.settings.parallelism

    def place(table: str) -> tuple[str, list[str], str | None]:
        url = options.get("url") or with_server_time_zone(job.urls[table])
        rule = job.filters.get(table, UNREGISTERED)
        return url, list(job.specs[table].keys), predicate_sql(rule, since, lambda c: quoted(spark, url, c))

    def ranges(table: str) -> list[str]:
        url, keys, condition = place(table)
        return key_ranges(spark, url, table, keys, args.ranges, condition, **rest)

    def scan(table: str, key_range: str | None = None):
        url, keys, condition = place(table)
        condition = " and ".join(f"({c})" for c in (condition, key_range) if c) or None
        return read_jdbc(spark, url, table, partitions=partitions, split_keys=keys, condition=condition, **rest)

    ledger = ranges if args.ranges > 1 else None
    return batch_sync(
        spark, job.specs, job.filters, scan, since, args.root, rules, on_error=args.on_error, batch_id=args.run, ranges=ledger
    )


def run_compact(spark: SparkSession, args: argparse.Namespace) -> dict[str, bool]:
    job = load(spark, args)
    return compact_tables(spark, job.specs, args.root, full=True if args.full else None)


def main(argv: list[str] | None = None) -> None:
    args = parse_args(argv)
    spark = SparkSession.builder.appName(getattr(args, "jobName", f"{args.command} {args.db}")).getOrCreate()
    if args.command == "stream":
        run_stream(spark, args).awaitTermination()
    elif args.command == "compact":
        print(run_compact(spark, args))
    else:
        # One row for each table, all of which stand in the audit folder too.
        for row in run_batch(spark, args).orderBy("status", "table").collect():
            print(row.table, row.target, row.status, row.upserts, row.error or "")


if __name__ == "__main__":
    main()
