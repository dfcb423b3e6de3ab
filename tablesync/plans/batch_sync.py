"""Batch back-fill of a job's tables."""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.operators.audit import AuditRow, audit_frame, write_audit
from tablesync.operators.backfill import UNREGISTERED, rows_since
from tablesync.operators.keyed_table import KeyedTable
from tablesync.operators.sensitive import mask_columns
from tablesync.spec import NO_MASKING, MaskRules, TableSpec
from tablesync.streaming.sync import noted_once, run_parallel

# A back-fill row beats every streamed change at the same log offset.
AFTER_ROW = 2**31 - 1
# Key ranges that a run may have; a range's batch id is its run's times this, plus its number.
RANGES = 1_000_000


class BackfillError(RuntimeError):
    """A table failed; ``done`` lists the tables that succeeded before."""

    def __init__(self, table: str, cause: str, done: list[str]):
        super().__init__(f"back-fill of {table} failed: {cause}; done: {', '.join(done) or 'none'}")
        self.table = table
        self.done = done


def backfill_rows(
    rows: DataFrame, spec: TableSpec, rule: str, since: str, rules: MaskRules = NO_MASKING
) -> DataFrame:
    """The rows of one table changed since a time, masked, as upserts without a position."""
    changed = rows_since(rows, rule, since)
    shaped = changed.select(*[F.col(f"`{c.name}`").cast(c.target).alias(c.name) for c in spec.columns])
    return mask_columns(shaped, spec, rules).withColumn("_op", F.lit("upsert"))


def batch_sync(
    spark: SparkSession,
    specs: dict[str, TableSpec],
    filters: dict[str, str],
    scan: Callable[..., DataFrame],
    since: str,
    root: str,
    rules: MaskRules = NO_MASKING,
    position: dict[str, int] | None = None,
    label: str = "backfill",
    batch_id: int | None = None,
    on_error: str = "stop",
    parallel_tables: int = 1,
    buckets: int | None = None,
    ranges: Callable[[str], list[str]] | None = None,
) -> DataFrame:
    """Back-fill every table of ``specs`` and return the audit rows.

    With ``ranges``, which gives a table's key ranges as conditions, ``scan`` is called with a table and a range, and each
    range is applied by itself. A run's ranges and position are noted at its start, and the commits say which
    ranges are done: a run with the ``batch_id`` of one that failed goes on with the first range that is not.

    ``position`` is the source's log position recorded before the scans start, so
    that a newer streamed change wins over an older scanned row. Without it the
    last position the target has applied is used. Of runs at one position the last
    wins. Should a scan in ranges of a live table meet a key twice, one row stays.
    """
    batch_id = int(time.time() * 1000) if batch_id is None else batch_id
    rows: list[AuditRow] = []

    def one_table(name: str) -> None:
        spec = specs[name]
        row = AuditRow(label, batch_id, name, spec.target, status="running")
        rows.append(row)
        try:
            rule = filters.get(name, UNREGISTERED)
            table = KeyedTable.of(spark, root, spec, buckets=buckets)
            at = {**(position or table.state().last_seq or {}), "row": AFTER_ROW}
            if ranges is not None:
                apply_ranges(table, name, rule, at, row)
                return
            changes = backfill_rows(scan(name), spec, rule, since, rules).withColumn("_seq", table.position(at))
            result = table.apply(changes, label, batch_id)
            row.events = row.upserts = result["upserts"]
            row.status = "skipped" if result["skipped"] else "ok"
        except Exception as error:
            row.status, row.error = "failed", str(error) or type(error).__name__
            if on_error == "stop":
                raise BackfillError(name, row.error, [r.table for r in rows if r.status == "ok"]) from error

    def apply_ranges(table: KeyedTable, name: str, rule: str, at: dict, row: AuditRow) -> None:
        plan = f"{label}-{batch_id}-{specs[name].target}.ranges"
        told = json.loads(noted_once(spark, root, plan, lambda: json.dumps({"ranges": ranges(name), "position": at})))
        own, first = f"{label}-ranges", batch_id * RANGES
        last = table.state().last_by_label.get(own)
        done, total = 0, 0
        if last is not None and last["batch_id"] >= first:
            done, total = last["batch_id"] - first + 1, last["notes"]["before"] + last["upserts"]
        row.status = "skipped" if done >= len(told["ranges"]) else "running"
        for i, part in enumerate(told["ranges"][done:], done):
            changes = backfill_rows(scan(name, part), specs[name], rule, since, rules)
            changes = changes.withColumn("_seq", table.position(told["position"]))
            total += table.apply(changes, own, first + i, lambda before=total: {"before": before})["upserts"]
        row.events = row.upserts = total
        row.status = "skipped" if row.status == "skipped" else "ok"

    try:
        run_parallel(spark, one_table, list(specs), parallel_tables)
    finally:
        write_audit(spark, root, rows, label, batch_id)
    return audit_frame(spark, rows)
