"""Whole-database sync: one stream of change events into one keyed target per table."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import asdict, dataclass, field, replace
from functools import reduce

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tablesync.operators.audit import AuditRow, fold_audit, write_audit
from tablesync.operators.keyed_table import IMAGES, KeyedTable, skipped_batch
from tablesync.operators.latest import latest_per_key
from tablesync.operators.routing import classify
from tablesync.operators.typed import typed_rows
from tablesync.sources.change_events import binlog_position, parse_envelope, start_at
from tablesync.sources.epochs import Epoch, Seen, Servers, epoch_of, gtid_number, gtid_source
from tablesync.sources.files import list_files, publish_text, read_text
from tablesync.sources.kafka import to_records
from tablesync.spec import DEFAULT_TIME_ZONE, NO_MASKING, MaskRules, TableSpec
from tablesync.streaming.multi_log import vacuum_parts, write_parts


@dataclass
class SyncOptions:
    """How a sync job behaves; ``label`` must change when its checkpoint is thrown away.

    ``start`` is ``earliest``, ``latest`` or a time in epoch milliseconds; a stream fixes ``latest`` at its first
    start. Events of unlisted tables go to quarantine, stop the job (``fail``) or are left out (``ignore``).
    ``fold_every`` is the number of applied batches a table may collect before its log is folded
    inside the stream, which costs as much as the log; new bases are written by a job of their own (``compact_tables``).
    Truncations empty their table as it stands at their position, or go to quarantine. ``epochs`` are the servers'
    reigns, where they are known better than from the events (see ``sources.epochs``).
    """

    label: str = "sync"
    db: str | None = None
    rules: MaskRules = NO_MASKING
    time_zone: str = DEFAULT_TIME_ZONE
    buckets: int | None = None
    seq: Column | None = None
    seq_type: str | None = None
    truncates: str = "apply"
    epochs: tuple[Epoch, ...] | None = None
    on_unknown: str = "quarantine"
    new_columns: str = "ignore"
    on_overflow: str = "quarantine"
    start: str | int = "earliest"
    fold_every: int | None = 50
    parallel_tables: int = 4
    table_options: dict = field(default_factory=dict)

    def keyed_options(self) -> dict:
        options = {"buckets": self.buckets, **self.table_options}
        return {**options, "seq_type": self.seq_type} if self.seq_type else options


def stage(events: DataFrame, specs: dict[str, TableSpec], options: SyncOptions) -> DataFrame:
    """Parsed events of the job's database and time with their ``_action``."""
    if options.truncates not in ("apply", "quarantine"):
        raise ValueError(f"truncates must be apply or quarantine, not {options.truncates}")
    staged = start_at(classify(parse_envelope(events), list(specs), options.truncates == "apply"), options.start)
    if options.on_unknown == "ignore":
        staged = staged.where(F.col("_action") != "unknown_table")
    elif options.on_unknown not in ("quarantine", "fail"):
        raise ValueError(f"on_unknown must be quarantine, fail or ignore, not {options.on_unknown}")
    if options.db is None:
        return staged
    # Text without a database is no event of another one: it goes to quarantine.
    return staged.where(F.coalesce(F.col("db") == options.db, F.lit(True)))


def typed_changes(staged: DataFrame, spec: TableSpec, options: SyncOptions) -> DataFrame:
    mine = staged.where((F.col("table") == spec.table) & F.col("_action").isin("upsert", "delete"))
    return typed_rows(
        mine, spec, options.rules, options.time_zone, options.seq, options.new_columns, options.on_overflow
    )


def sync_batch(
    events: DataFrame,
    batch_id: int,
    specs: dict[str, TableSpec],
    root: str,
    options: SyncOptions,
    tables: dict[str, KeyedTable] | None = None,
) -> list[AuditRow]:
    """Apply one batch of event text to every table it has changes for.

    The batch is parsed once and kept, ordered by table inside each partition so
    that each table's scan skips the other tables' blocks. The changes of all tables are written at once, see
    ``multi_log``. A lost executor's part is read again from the source. What goes to quarantine is written before the
    commit it belongs to, so a batch that died anywhere is finished by its repeat. ``tables`` keeps
    the targets and what they know of their commits from batch to batch.
    """
    spark = events.sparkSession
    tables = {} if tables is None else tables
    with placed_batch(events, specs, root, options) as batch:
        staged, options, active, odd = batch.rows, batch.options, batch.active, batch.odd
        if odd.get("unknown_table") and options.on_unknown == "fail":
            raise ValueError(f"batch {batch_id}: {odd['unknown_table']} events of tables that are not in the job")

        if odd:
            rest = staged.where(~F.col("_action").isin("upsert", "delete", "truncate"))
            quarantine(rest, root, options.label, batch_id, "_events")
        for name in active:
            if name not in tables:
                tables[name] = KeyedTable.of(spark, root, specs[name], **options.keyed_options())
        rows = _apply_batch(spark, batch, batch_id, specs, tables, root)
        rows += [AuditRow(options.label, batch_id, None, None, n, quarantined=n, status=kind) for kind, n in odd.items()]
        write_audit(spark, root, rows, options.label, batch_id)
        return rows


@dataclass
class PlacedBatch:
    """A batch's events, parsed and kept, with what must be known of it before any table takes its part.

    ``active`` are the events of each table, ``odd`` those of none by their action, ``truncated`` the
    position of each table's last truncation; ``options`` place events in the servers' epochs.
    """

    rows: DataFrame
    options: SyncOptions
    active: dict[str, int]
    odd: dict[str, int]
    truncated: dict[str, dict]


@contextmanager
def placed_batch(events: DataFrame, specs: dict[str, TableSpec], root: str, options: SyncOptions) -> Iterator[PlacedBatch]:
    spark = events.sparkSession
    staged = stage(events, specs, options).sortWithinPartitions("table").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # At most one row per listed table, action, server and source of transaction ids.
        counts = batch_counts(staged).collect()
        active: dict[str, int] = {}
        odd: dict[str, int] = {}
        for r in counts:
            where, name = (odd, r["_action"]) if r.table is None else (active, r.table)
            where[name] = where.get(name, 0) + r.events
        placed = _with_epochs(spark, root, options, counts)
        truncated = _truncations(staged, placed) if any(r["_action"] == "truncate" for r in counts) else {}
        yield PlacedBatch(staged, placed, active, odd, truncated)
    finally:
        staged.unpersist()


def batch_counts(staged: DataFrame) -> DataFrame:
    """Events per table, action and origin; all that go to no table count under one row of their action."""
    table = F.when(F.col("_action").isin("upsert", "delete", "truncate"), F.col("table"))
    return staged.groupBy(table.alias("table"), "_action", "server_id", gtid_source().alias("source")).agg(
        F.count("*").alias("events"),
        F.max(gtid_number()).alias("last_number"),
        F.min("ts_ms").alias("first_ms"),
        F.max("ts_ms").alias("last_ms"),
    )


def _with_epochs(spark: SparkSession, root: str, options: SyncOptions, counts: list) -> SyncOptions:
    """The options with positions that tell the servers' reigns apart, which the job's note keeps over restarts."""
    if options.seq is not None:
        return options
    if options.epochs is not None:
        epochs = list(options.epochs)
    else:
        name, folder = f"{options.label}.servers", f"{root}/_jobs"
        told = json.loads(read_text(spark, f"{folder}/{name}")) if list_files(spark, f"{folder}/{name}") else None
        servers = Servers.load(told)
        placed = [r for r in counts if r.table is not None and r.first_ms is not None]
        servers.observe(Seen(r.server_id, r.source, r.last_number, r.first_ms, r.last_ms) for r in placed)
        if servers.saved() != (told or Servers().saved()):
            publish_text(spark, folder, name, json.dumps(servers.saved()), replace=True)
        epochs = servers.epochs
    return replace(options, seq=binlog_position(epoch=epoch_of(epochs)), epochs=tuple(epochs))


def _truncations(staged: DataFrame, options: SyncOptions) -> dict[str, dict]:
    """The position of the last truncation of each table; what was before an earlier one is before the last."""
    seq = binlog_position() if options.seq is None else options.seq
    rows = staged.where(F.col("_action") == "truncate").groupBy("table").agg(F.max(seq).alias("seq"))
    return {r.table: r.seq.asDict() for r in rows.collect() if r.seq is not None}


def _apply_batch(
    spark: SparkSession, batch: PlacedBatch, batch_id: int, specs: dict[str, TableSpec], tables: dict[str, KeyedTable], root: str
) -> list[AuditRow]:
    """One write for all tables, then a commit for each; a table that has the batch already is left out."""
    options, names = batch.options, sorted(batch.active)
    states = dict(zip(names, run_parallel(spark, lambda n: tables[n].state(), names, options.parallel_tables), strict=True))
    known = {n: skipped_batch(states[n], options.label, batch_id) for n in names}
    todo = {n: batch.active[n] for n in names if known[n] is None}
    write = max([tables[n].next_write(states[n]) for n in todo], default=0)
    kept = sum(batch.active.values()) + sum(batch.odd.values())
    parts = write_parts(
        lambda spec: typed_changes(batch.rows, spec, options), tables, specs, todo, root, options.label, batch_id, write, kept
    )

    def one_table(name: str) -> AuditRow:
        table, spec = tables[name], specs[name]
        row = AuditRow(options.label, batch_id, spec.table, spec.target, batch.active[name])
        if (done := known[name]) is None:
            part, at = parts[name], batch.truncated.get(name)
            if part.bad:
                kind = F.when(F.col("_deleted"), "delete").otherwise("upsert").alias("_op")
                bad = table.image_rows([part.folder], bad=True)
                bad = bad.select(*[F.col(f"`{n}`") for n in spec.column_names], kind, "_seq", "_bad")
                quarantine(bad, root, options.label, batch_id, spec.target)
            done = table.commit_log(
                states[name],
                options.label,
                batch_id,
                write,
                folder=part.folder if part.upserts or part.deletes else None,
                form=IMAGES,
                upserts=part.upserts,
                deletes=part.deletes,
                first_seq=part.first_seq,
                last_seq=part.last_seq,
                notes={
                    "events": batch.active[name],
                    "quarantined": part.bad,
                    "epochs": [asdict(e) for e in options.epochs or ()],
                },
                ranges=[] if at is None else [{"condition": None, "seq": at}],
            )
        row.upserts, row.deletes = done["upserts"], done["deletes"]
        if done["notes"] is None:
            # Not the last batch of this label: its own audit was written when it was.
            row.status = "skipped"
        else:
            row.events, row.quarantined = done["notes"]["events"], done["notes"]["quarantined"]
        if options.fold_every and len(states[name].logs) + 1 >= options.fold_every:
            table.compact(full=False)
        return row

    return run_parallel(spark, one_table, names, options.parallel_tables)


def quarantine(rows: DataFrame, root: str, label: str, batch_id: int, name: str) -> int:
    """Keep what could not be applied, whole, beside the targets."""
    seen = Observation()
    rows.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(
        f"{root}/_quarantine/{name}/job={label}/batch={batch_id}"
    )
    return seen.get["n"]


def run_parallel(spark: SparkSession, work: Callable, items: list, threads: int) -> list:
    """Run one Spark job chain per item; the threads only submit jobs."""
    if threads <= 1 or len(items) <= 1:
        return [work(i) for i in items]
    with ThreadPoolExecutor(max_workers=threads) as pool:
        return list(pool.map(inheritable_thread_target(spark)(work), items))


def topic_records(staged: DataFrame, specs: dict[str, TableSpec], options: SyncOptions) -> DataFrame:
    """Kafka records of a whole database: one topic per table, a null value for a delete.

    One record for each key, its last change, so the order of a batch's records says nothing and batches
    follow each other. The reduction comes before the shuffle, so a hot key is one row per task.
    """
    parts = []
    for spec in specs.values():
        rows = typed_changes(staged, spec, options).where(F.col("_bad").isNull())
        rows = latest_per_key(rows, list(spec.keys), "_seq")
        rows = rows.select(*[F.col(f"`{n}`") for n in spec.column_names], (F.col("_op") == "delete").alias("_gone"))
        parts.append(to_records(rows, list(spec.keys), spec.target, deleted="_gone"))
    return reduce(DataFrame.unionByName, parts)


def noted_once(spark: SparkSession, root: str, name: str, text: Callable[[], str]) -> str:
    """What stands in a job's note: this text, if it is the first."""
    folder = f"{root}/_jobs"
    if not list_files(spark, f"{folder}/{name}"):
        publish_text(spark, folder, name, text())
    return read_text(spark, f"{folder}/{name}")


def first_start(spark: SparkSession, root: str, options: SyncOptions) -> SyncOptions:
    """The options with ``latest`` as the time of the job's first start, which restarts keep."""
    if options.start != "latest":
        return options
    return replace(options, start=int(noted_once(spark, root, f"{options.label}.start", lambda: str(int(time.time() * 1000)))))


def bind_label(spark: SparkSession, root: str, label: str, checkpoint: str) -> str:
    """Tie a label to its checkpoint: another checkpoint counts its batches anew, and they would be skipped."""
    query = json.loads(read_text(spark, f"{checkpoint}/metadata"))["id"]
    known = noted_once(spark, root, f"{label}.query", lambda: query)
    if known != query:
        raise ValueError(f"label {label} belongs to another checkpoint than {checkpoint}: take a new label")
    return query


def compact_tables(
    spark: SparkSession, specs: dict[str, TableSpec], root: str, options: SyncOptions | None = None, **how
) -> dict[str, bool]:
    """Compact every target and remove what is old: a job beside the streams. Says which had a log."""
    options = options or SyncOptions()

    def one_table(name: str) -> bool:
        table = KeyedTable.of(spark, root, specs[name], **options.keyed_options())
        done = table.compact(**how)
        table.vacuum()
        return done

    done = dict(zip(specs, run_parallel(spark, one_table, list(specs), options.parallel_tables), strict=True))
    vacuum_parts(spark, root)
    fold_audit(spark, root)
    return done


def sync_stream(
    events: DataFrame,
    specs: dict[str, TableSpec],
    root: str,
    checkpoint: str | None = None,
    options: SyncOptions | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start the sync of a stream with a text column ``value``.

    To add a table, stop the query, extend ``specs`` and start again with the same
    checkpoint: its events flow from then on, a back-fill brings the rows before.
    """
    options, spark = options or SyncOptions(), events.sparkSession
    options = first_start(spark, root, options)
    tables = {s.table: KeyedTable.of(spark, root, s, **options.keyed_options()) for s in specs.values()}
    for table in tables.values():
        table.create()
    checkpoint = checkpoint or f"{root}/_checkpoints/{options.db or options.label}"
    bound = []

    def handle(batch: DataFrame, batch_id: int) -> None:
        if not bound:
            bound.append(bind_label(spark, root, options.label, checkpoint))
        sync_batch(batch, batch_id, specs, root, options, tables)

    return (
        events.writeStream.foreachBatch(handle)
        .queryName(options.label)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start()
    )


def run_available(
    spark: SparkSession, events: DataFrame, specs: dict[str, TableSpec], root: str, options: SyncOptions | None = None
) -> None:
    """A bounded run: take everything the source has now, then stop."""
    query = sync_stream(events, specs, root, options=options, trigger={"availableNow": True})
    query.awaitTermination()
