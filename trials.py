"""Larger trials on one machine: a hot log reduced, a large target applied, compacted and changed by one per cent.

``python trials.py [millions]``; prints one JSON line. The rows are made by Spark from a range.
"""

from __future__ import annotations

import json
import sys
import tempfile
import time

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.operators.keyed_table import KeyedTable
from tablesync.operators.latest import latest_per_key
from tablesync.session import local_session
from tablesync.sources.files import folder_size

SCHEMA = T.StructType().add("id", "long", False).add("line", "integer", False).add("price", "double").add("note", "string")


def seconds(work) -> float:
    start = time.perf_counter()
    work()
    return round(time.perf_counter() - start, 1)


def bytes_read(spark, work) -> int:
    """Bytes that a piece of work reads from files; shuffles are not among them."""
    def total() -> int:
        return sum(s.getBytesRead() for s in spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics())

    before = total()
    work()
    return total() - before


def changes(spark, first: int, rows: int, position: int):
    ids = spark.range(first, first + rows)
    return ids.select(
        (F.col("id") / 4).cast("long").alias("id"),
        (F.col("id") % 4).cast("int").alias("line"),
        (F.col("id") % 9973 / 7).alias("price"),
        F.md5(F.col("id").cast("string")).alias("note"),
        F.lit("upsert").alias("_op"),
        F.struct(F.lit(1).cast("long").alias("file_no"), F.lit(position).cast("long").alias("pos"), F.col("id").alias("row")).alias("_seq"),
    )


def main(millions: int) -> None:
    folder = tempfile.mkdtemp(prefix="tablesync-trial-")
    # Vectored reads of local files are not counted in the bytes read.
    more = {"parquet__hadoop__vectored__io__enabled": "false"}
    spark = local_session(8, spark__checkpoint__dir=folder, spark__sql__warehouse__dir=f"{folder}/warehouse", **more)
    rows, out = millions * 1_000_000, {"rows": millions * 1_000_000}
    # A third of the log is of one key.
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.pmod(F.xxhash64("id"), F.lit(rows // 20)))
    log = spark.range(rows).select(key.alias("key"), F.col("id").alias("at"), F.md5(F.col("id").cast("string")).alias("v"))
    out["latest_per_key"] = seconds(lambda: latest_per_key(log, ["key"], "at").write.format("noop").mode("overwrite").save())
    table = KeyedTable(spark, f"{folder}/t", SCHEMA, ["id", "line"])
    out["apply"] = seconds(lambda: table.apply(changes(spark, 0, rows, 0), "log", 0))
    out["compact"] = seconds(table.compact)
    out["apply_one_per_cent"] = seconds(lambda: table.apply(changes(spark, rows // 2, rows // 100, 1), "log", 1))
    out["read"] = seconds(lambda: table.read().write.format("noop").mode("overwrite").save())
    # A batch of 0.1 per cent on a fresh base: its keys' merged rows against the bytes of the base.
    table.compact(full=True)
    few = changes(spark, rows // 3, rows // 1000, 2)
    table.apply(few, "log", 2)
    base_bytes = folder_size(spark, f"{folder}/t/{table.state().base['folder']}")
    read = bytes_read(spark, lambda: out.update(changed=table.read_keys(few).count()))
    out["read_changed_share_of_base"] = round(read / base_bytes, 4)
    out["read_one_key"] = seconds(lambda: table.read().where("id = 77").collect())
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main(int(sys.argv[1]) if len(sys.argv) > 1 else 12)
