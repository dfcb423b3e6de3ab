"""What was applied, quarantined or failed, per table and batch."""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.sources.files import delete_folder, list_files, publish_text

AUDIT_SCHEMA = (
    "job string, batch_id bigint, table string, target string, events bigint, upserts bigint,"
    " deletes bigint, quarantined bigint, status string, error string"
)


@dataclass
class AuditRow:
    job: str
    batch_id: int
    table: str | None
    target: str | None = None
    events: int = 0
    upserts: int = 0
    deletes: int = 0
    quarantined: int = 0
    status: str = "ok"
    error: str | None = None


def audit_frame(spark: SparkSession, rows: list[AuditRow]) -> DataFrame:
    return spark.createDataFrame([tuple(asdict(r).values()) for r in rows], AUDIT_SCHEMA)


def write_audit(spark: SparkSession, root: str, rows: list[AuditRow], job: str, batch_id: int) -> None:
    """One small file per batch; a repeated batch replaces its own."""
    if rows:
        text = "".join(json.dumps(asdict(r)) + "\n" for r in rows)
        publish_text(spark, f"{root}/_audit/{job}", f"batch-{batch_id}.json", text, replace=True)


def read_audit(spark: SparkSession, root: str) -> DataFrame:
    """All rows; one that is in a batch's file and in a folded one at the same time counts once."""
    paths = [p for p in (f"{root}/_audit/*/*.json", f"{root}/_audit/*/folded-*/*.json") if list_files(spark, p)]
    return spark.read.schema(AUDIT_SCHEMA).json(paths).distinct() if paths else audit_frame(spark, [])


def fold_audit(spark: SparkSession, root: str, least: int = 16) -> int:
    """Put the files of a job's batches into one, once there are ``least``; says how many.

    The newest batch's file stays, because a repeat of the batch replaces it. A reader meanwhile sees a row in both
    files or in one, never in none.
    """
    folded = 0
    for job in list_files(spark, f"{root}/_audit/*"):
        batches = [f for f in list_files(spark, f"{job}/batch-*.json")]
        batches.sort(key=lambda f: int(re.sub(r".*/batch-(\d+)\.json$", r"\1", f)))
        before = list_files(spark, f"{job}/folded-*")
        if len(batches) <= least:
            continue
        old = batches[:-1] + (before if len(before) >= least else [])
        rows = spark.read.schema(AUDIT_SCHEMA).json(old).distinct()
        rows.coalesce(1).write.json(f"{job}/folded-{uuid.uuid4().hex[:12]}")
        for path in old:
            delete_folder(spark, path)
        folded += len(old)
    return folded


def summarise(audit: DataFrame) -> DataFrame:
    """Totals per table and status."""
    return audit.groupBy("table", "target", "status").agg(
        *[F.sum(c).alias(c) for c in ("events", "upserts", "deletes", "quarantined")]
    )
