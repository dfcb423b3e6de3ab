"""From the metadata tables to a ready job: settings, table specs, filters, targets."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.operators.backfill import choose_filters, choose_filters_by_text
from tablesync.operators.catalog import catalog_lookup, missing_targets, prefixed
from tablesync.operators.ddl import ddl_columns, table_specs
from tablesync.operators.keyed_table import KeyedTable
from tablesync.sources.files import list_files
from tablesync.sources.settings import JobSettings, job_tables, load_job, mask_rules, read_properties
from tablesync.spec import NO_MASKING, MaskRules, TableSpec


@dataclass(frozen=True)
class Metadata:
    """The metadata tables; ``definitions`` is ``([db_name,] table_name, ddl)``. None holds a secret."""

    jobs: DataFrame
    imports: DataFrame
    connections: DataFrame
    definitions: DataFrame

    @classmethod
    def load(cls, spark: SparkSession, folder: str, file_format: str = "json") -> Metadata:
        names = ("sync_jobs", "meta_import", "meta_connections", "definitions")
        return cls(*[spark.read.format(file_format).load(f"{folder}/{n}") for n in names])


@dataclass(frozen=True)
class SyncJob:
    settings: JobSettings
    specs: dict[str, TableSpec]
    filters: dict[str, str]
    urls: dict[str, str]


def prepare_job(
    spark: SparkSession, metadata: Metadata, db: str, filter_match: str = "columns", table_prefix: str | None = None
) -> SyncJob:
    """Everything a job needs to know about its tables; collects their metadata, never data.

    A table without import entry, connection, definition or key is an error that names it.
    ``filter_match="ddl_text"`` searches the whole definition for update columns. With a
    ``table_prefix`` a target is named by it and the table, not by its import entry.
    """
    settings = load_job(metadata.jobs, db)
    wanted = job_tables(metadata.jobs, db).select(F.lit(db).alias("db_name"), "table_name").distinct()
    found = {r.table_name: r for r in catalog_lookup(wanted, metadata.imports, metadata.connections).collect()}
    lost = {t: r.status for t, r in found.items() if r.status != "ok"}
    if lost:
        raise ValueError(f"incomplete metadata: {lost}")
    ddls = metadata.definitions.where(F.col("table_name").isin(*settings.tables))
    if "db_name" in ddls.columns:
        ddls = ddls.where(F.col("db_name") == db)
    targets = {t: r.target if table_prefix is None else prefixed(t, table_prefix) for t, r in found.items()}
    specs = table_specs(ddls, targets)
    undefined = [t for t in settings.tables if t not in specs]
    if undefined:
        raise ValueError(f"no definition of {undefined}")
    chosen = choose_filters_by_text(ddls) if filter_match == "ddl_text" else choose_filters(ddl_columns(ddls))
    filters = {r.table_name: r.rule for r in chosen.collect()}
    return SyncJob(
        settings, {t: specs[t] for t in settings.tables}, filters, {t: r.url for t, r in found.items()}
    )


def existing_targets(spark: SparkSession, root: str, db: str = "ods") -> DataFrame:
    """Targets that have a commit: ``db, target``."""
    folders = list_files(spark, f"{root}/*/commits")
    names = sorted({f.rstrip("/").split("/")[-2] for f in folders})
    return spark.createDataFrame([(db, n) for n in names], "db string, target string")


def create_missing_targets(
    spark: SparkSession, specs: dict[str, TableSpec], root: str, db: str = "ods", buckets: int | None = None
) -> list[str]:
    """Create the targets of a job that do not exist; says which."""
    by_target = {s.target: s for s in specs.values()}
    wanted = spark.createDataFrame([(db, t) for t in by_target], "db string, target string")
    lost = sorted(r.target for r in missing_targets(wanted, existing_targets(spark, root, db)).collect())
    for target in lost:
        KeyedTable.of(spark, root, by_target[target], buckets=buckets).create()
    return lost


def load_mask_rules(spark: SparkSession, mask_mode: str, path: str) -> MaskRules:
    """The rules of a property file in mode ``mask``; nothing is masked in mode ``unmask``."""
    return mask_rules(read_properties(spark, path)) if mask_mode.lower() == "mask" else NO_MASKING
