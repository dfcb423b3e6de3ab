"""Session helpers: a tuned local session and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_local_folders: dict[str, str] = {}


def local_session(cpus: int | str = 8, **conf: str) -> SparkSession:
    """A session for tests and bench runs on one machine; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tablesync")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("TABLESYNC_DRIVER_MEMORY", "8g"))
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may go without the setting; it then gets a temporary
    folder, because driver and executors are the same machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="tablesync-")
    return _local_folders[app]


def run_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder, for the tables of one run."""
    return f"{shared_folder(spark)}/tablesync/{name}-{uuid.uuid4().hex[:12]}"
