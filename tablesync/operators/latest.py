"""Last write per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(rows: DataFrame, keys: list[str], order: Column | str) -> DataFrame:
    """The row with the greatest ``order`` of every key; ``order`` must have no ties in a key.

    Spark keeps only the best row per key of each map task before the shuffle
    (``WindowGroupLimit``), so a hot key sends one row per task.
    """
    order = F.col(order) if isinstance(order, str) else order
    newest_first = Window.partitionBy(*keys).orderBy(order.desc())
    return rows.withColumn("_rank", F.row_number().over(newest_first)).where(F.col("_rank") == 1).drop("_rank")
