"""Mixing sources to target weights along a curriculum that changes with time, in DataFrame functions only.

Every source gets a target of words by its weight, stopped at ``cap`` times its size; the
excess goes to the others by weight, which is the level ``L`` of ``min(cap * size, L * weight)``.
A source's weight changes over the training time from 0 to 1. The integral of its
schedule is its cumulative demand in words; a document that starts at word ``c`` of its
source's passes is trained where the demand reaches ``c``. Documents are sorted by that
position with a range sort.

The running sum over a source is taken in two steps, so a source with a third of
all rows is no one task's work: rows fall into ranges of a hash of id and text in each
source, as many as leave about ``RANGE_ROWS`` rows for a range, the ranges' sums are added up per source, and the rows only
within their range. Rows that repeat an id, or have none, spread over the ranges by their texts. The table of sources has one row for each source; its ranks are
counted in one task.

Defined cases: a null text has no words; null sources are one source, which comes last; a
document without words takes none; of rows that repeat an id each counts as
a document; if no document has words, all targets are 0; an empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablesync.llm.common import whole_id, whole_text

WORD = r"[^\x20\x09-\x0D]+"
# Rows of a source's range if it had all rows; no fewer than 4,096 ranges.
RANGE_ROWS, RANGE_BITS = 1 << 14, 12
ORDER_BITS = 60
# Start and end of a source's schedule around its mean of 1, repeating as the weights do:
# heavy sources fade out, light ones come in. Both ends are above 0 and their mean is 1.
SCHEDULES = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))


def by_turn(values: tuple[float, ...], rank: Column) -> Column:
    return F.get(F.array(*[F.lit(float(v)) for v in values]), (rank % len(values)).cast("int"))


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, cap: float = 2.0
) -> DataFrame:
    """Per source (``_none``, ``_source``) of ``sizes`` its rank, words, weight and target."""
    sources = sizes.groupBy("_none", "_source").agg(F.sum("_size").alias("_source_size"))
    ordered = Window.orderBy("_none", "_source")
    sources = sources.withColumn("_rank", F.row_number().over(ordered) - 1)
    sources = sources.withColumn("_weight", by_turn(weights, F.col("_rank")))
    sources = sources.withColumn("_cap", F.lit(float(cap)) * F.col("_source_size"))
    # The sources stop in the order of cap over weight; the first that doesn't stop sets the level.
    filling = Window.orderBy(F.col("_cap") / F.col("_weight"), "_rank")
    before, rest = filling.rowsBetween(Window.unboundedPreceding, -1), filling.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy(F.lit(1))
    left = float(share) * F.sum("_source_size").over(whole) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    sources = sources.withColumn("_level", left / F.sum("_weight").over(rest))
    goes_on = F.col("_level") <= F.col("_cap") / F.col("_weight")
    level = F.min(F.when(goes_on & (F.col("_cap") > 0), F.struct(F.col("_cap") / F.col("_weight"), "_rank", "_level")))
    sources = sources.withColumn("_level", level.over(whole)["_level"])
    target = F.least("_cap", F.coalesce(F.col("_level") * F.col("_weight"), F.col("_cap")))
    return sources.select("_none", "_source", "_rank", "_source_size", target.alias("_target"))


def dealt_order(id_col: str, text: Column) -> Column:
    """A place in its source for every row: the first ``ORDER_BITS`` bits of the MD5 of id and text."""
    name = F.md5(F.concat_ws(":", F.coalesce(whole_id(id_col).cast("string"), F.lit("")), text))
    return F.conv(F.substring(name, 1, ORDER_BITS // 4), 16, 10).cast("long")


def when_reached(share: Column, start: Column, end: Column) -> Column:
    """The time at which the integral of a schedule from ``start`` to ``end`` reaches ``share`` of the whole."""
    return 2 * share / (start + F.sqrt(start * start + 2 * (end - start) * share))


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = (5, 2, 1),
    share: float = 1.5,
    cap: float = 2.0,
    schedules: tuple[tuple[float, float], ...] = SCHEDULES,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """Every row as ``_row`` columns ``c0``, ``c1``, ... in their order, with what the mix decides about it.

    ``_size``, ``_source_size``, ``_target``; ``_taken``, the words taken in all passes; ``_first``,
    the training time of the first pass; ``_passes``, an array of (words taken, time) of all passes.
    """
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    bits = max(RANGE_BITS, (docs.count() // RANGE_ROWS).bit_length())
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    text = whole_text(names[text_col])
    rows = rows.withColumns(
        {
            "_none": F.col(names[source_col]).isNull(),
            "_source": F.coalesce(F.col(names[source_col]).cast("string"), F.lit("")),
            "_size": F.regexp_count(text, F.lit(WORD)).cast("long"),
            "_order": dealt_order(names[id_col], text),
            "_tie": F.xxhash64(text),
        }
    ).withColumn("_range", F.shiftright("_order", ORDER_BITS - bits))

    sizes = rows.groupBy("_none", "_source", "_range").agg(F.sum("_size").alias("_size"))
    earlier = Window.partitionBy("_none", "_source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = sizes.withColumn("_before", F.coalesce(F.sum("_size").over(earlier), F.lit(0))).drop("_size")
    ranges = ranges.join(source_targets(sizes, weights, share, cap), ["_none", "_source"])

    within = Window.partitionBy("_none", "_source", "_range").orderBy("_order", names[id_col], "_size", "_tie")
    within = within.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_at", F.coalesce(F.sum("_size").over(within), F.lit(0)))
    rows = rows.join(ranges, ["_none", "_source", "_range"]).withColumn("_at", F.col("_at") + F.col("_before"))

    starts, ends = (by_turn(tuple(s[i] for s in schedules), F.col("_rank")) for i in (0, 1))
    most = F.floor("_target")

    def a_pass(p: Column) -> Column:
        at = F.col("_at") + p * F.col("_source_size")
        taken = F.greatest(F.lit(0).cast("long"), F.least("_size", most - at))
        time = F.when(F.col("_target") > 0, when_reached(F.least(F.lit(1.0), at / F.col("_target")), starts, ends))
        return F.struct(taken.alias("taken"), time.alias("time"))

    passes = F.transform(F.sequence(F.lit(0).cast("long"), F.lit(int(-(-cap // 1)) - 1).cast("long")), a_pass)
    rows = rows.withColumn("_passes", F.filter(passes, lambda p: p["taken"] > 0))
    taken = F.aggregate("_passes", F.lit(0).cast("long"), lambda n, p: n + p["taken"])
    rows = rows.withColumns({"_taken": taken, "_first": F.get("_passes", F.lit(0))["time"]})
    decided = ["_size", "_source_size", "_target", "_taken", "_first", "_passes"]
    return rows.select(*names.values(), *decided)


def curriculum(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix with all of their columns, a row for each pass, sorted by training time.

    A source's last pass ends within one document; it stays if half of it or more is taken.
    """
    mixed = mix(docs, **options)
    mixed = mixed.withColumn("_pass", F.explode("_passes")).where(F.col("_pass.taken") * 2 >= F.col("_size"))
    mixed = mixed.orderBy("_pass.time", F.xxhash64(*[f"c{i}" for i in range(len(docs.columns))]))
    return mixed.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
