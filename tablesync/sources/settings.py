"""Job rows, property files and masking rules."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.spec import MaskRules


def parse_properties(lines: DataFrame, value: str = "value", keep: list[str] | None = None) -> DataFrame:
    """``key=value`` lines as rows; comment and blank lines are dropped."""
    text = F.ltrim(F.regexp_replace(F.col(value), r"[\r\n]+\z", ""))
    parts = F.split(F.col("_text"), "=", 2)
    return (
        lines.select(*(keep or []), text.alias("_text"))
        .where(F.col("_text").contains("=") & ~F.col("_text").rlike(r"\A[#!]"))
        .select(*(keep or []), F.rtrim(parts[0]).alias("key"), F.ltrim(parts[1]).alias("value"))
    )


def read_properties(spark: SparkSession, path: str) -> dict[str, str]:
    """A property file on any file system Spark can read. Settings only: a few lines."""
    return {r.key: r.value for r in parse_properties(spark.read.text(path)).collect()}


def mask_rules(properties: dict[str, str]) -> MaskRules:
    def listed(key: str) -> tuple[str, ...]:
        return tuple(w.strip() for w in properties.get(key, "").split(",") if w.strip())

    return MaskRules(keywords=listed("keywordList"), id_only_tables=listed("unmaskingTable"))


def job_tables(jobs: DataFrame, db: str | None = None) -> DataFrame:
    """The tables of every job, in list order: ``mysql_db, position, table_name``."""
    if db is not None:
        jobs = jobs.where(F.col("mysqlDb") == db)
    listed = jobs.select(F.col("mysqlDb").alias("mysql_db"), F.posexplode(F.split("tableList", ",")))
    return (
        listed.select("mysql_db", F.col("pos").alias("position"), F.trim("col").alias("table_name"))
        .where(F.col("table_name") != "")
    )


@dataclass(frozen=True)
class JobSettings:
    db: str
    tables: tuple[str, ...]
    label_prefix: str
    parallelism: int
    checkpoint_interval_ms: int

    @property
    def trigger(self) -> dict[str, str]:
        return {"processingTime": f"{self.checkpoint_interval_ms} milliseconds"}


def load_job(jobs: DataFrame, db: str) -> JobSettings:
    """The job row of one database. An unknown database is an error."""
    row = jobs.where(F.col("mysqlDb") == db).orderBy("tableList", "dorisLablePrefix").first()
    if row is None:
        raise ValueError(f"no sync job is configured for database {db}")
    tables = tuple(t.strip() for t in row.tableList.split(",") if t.strip())
    return JobSettings(
        db, tables, row.dorisLablePrefix or "", int(row.parallelism or 1), int(row.checkpointInterval or 10_000)
    )
