"""Small files on any file system Spark can reach, through Hadoop's client."""

from __future__ import annotations

import time

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path):
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def list_files(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern, sorted; empty if there are none."""
    path = _path(spark, pattern)
    found = _file_system(spark, path).globStatus(path)
    return sorted(f.getPath().toString() for f in found) if found is not None else []


def list_with_age(spark: SparkSession, pattern: str) -> list[tuple[str, float]]:
    """Paths that match a glob pattern with the seconds since they were last changed."""
    path = _path(spark, pattern)
    found = _file_system(spark, path).globStatus(path)
    now = time.time()
    return sorted((f.getPath().toString(), now - f.getModificationTime() / 1000) for f in found or ())


def read_text(spark: SparkSession, path: str) -> str:
    target = _path(spark, path)
    stream = _file_system(spark, target).open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish_text(spark: SparkSession, folder: str, name: str, text: str, replace: bool = False) -> None:
    """Write a hidden file, then rename it, so that readers see all of it or nothing."""
    hidden, final = _path(spark, f"{folder}/_{name}.tmp"), _path(spark, f"{folder}/{name}")
    files = _file_system(spark, final)
    stream = files.create(hidden, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    if replace:
        _rename_over(spark, hidden, final)
    elif not files.rename(hidden, final):
        raise OSError(f"cannot publish {folder}/{name}")


def _rename_over(spark: SparkSession, hidden, final) -> None:
    """One step, with no moment in which the file is missing."""
    jvm = spark.sparkContext._jvm
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        _file_system(spark, final).getUri(), spark.sparkContext._jsc.hadoopConfiguration()
    )
    context.rename(hidden, final, options)


def delete_folder(spark: SparkSession, path: str) -> bool:
    target = _path(spark, path)
    return _file_system(spark, target).delete(target, True)


def folder_size(spark: SparkSession, path: str) -> int:
    """Bytes below a folder; 0 if there is none."""
    target = _path(spark, path)
    files = _file_system(spark, target)
    return files.getContentSummary(target).getLength() if files.exists(target) else 0
