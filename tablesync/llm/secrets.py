"""Secret scans with an incremental ledger of blobs, in DataFrame functions only.

Every version of every path is addressed by the SHA-256 of its content. The
ledger holds one row for each (blob, rule version) pair that was ever scanned,
with the spans found, so a run scans a blob once however many paths hold it, and
only under the rules whose version the ledger has not seen for it. Findings are
joined back to all paths. A run first compares addresses with the ledger, which moves 32 bytes for each blob; texts move
only for the blobs that a rule has not seen. The ledger is a folder of Parquet, one folder per run,
which Spark's writers publish whole or not at all.

Blobs are grouped by address *and* content, reduced in every map task, so a
file copied to a third of all paths sends one row per task. The join back is one
whose large partitions Spark splits.

Defined cases: a null text is empty; null paths and repeated rows are reported as they
come; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm.common import dealt_anew, whole_text
from tablesync.llm.graph import stored
from tablesync.sources.files import list_files

SPANS = "array<struct<start: int, stop: int>>"
LEDGER = f"blob string, rule string, version string, spans {SPANS}"


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern``, leftmost and non-overlapping; those whose ``group`` is shorter than ``least`` go."""

    kind: str
    pattern: str
    group: int
    least: int

    @property
    def version(self) -> str:
        return hashlib.sha256(f"{self.pattern}\n{self.group}\n{self.least}".encode()).hexdigest()[:16]

    def spans(self, text: Column) -> Column:
        """Start and stop of every match in code points, stop exclusive.

        The texts between the matches are what ``split`` returns, so the places follow from lengths.
        """
        found = F.regexp_extract_all(text, F.lit(self.pattern), F.lit(0))
        judged = F.regexp_extract_all(text, F.lit(self.pattern), F.lit(self.group))
        sizes = F.transform(
            F.arrays_zip(F.split(text, self.pattern, -1).alias("before"), found.alias("hit"), judged.alias("judged")),
            lambda x: F.struct(
                F.length(x["before"]).alias("before"),
                F.coalesce(F.length(x["hit"]), F.lit(0)).alias("hit"),
                F.coalesce(F.length(x["judged"]), F.lit(-1)).alias("judged"),
            ),
        )
        start = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("spans"))

        def step(done: Column, x: Column) -> Column:
            first = done["at"] + x["before"]
            span = F.struct(first.alias("start"), (first + x["hit"]).alias("stop"))
            spans = F.when(x["judged"] >= self.least, F.concat(done["spans"], F.array(span))).otherwise(done["spans"])
            return F.struct((first + x["hit"]).alias("at"), spans.alias("spans"))

        spans = F.aggregate(sizes, start, step)["spans"]
        return F.when(text.rlike(self.pattern), spans).otherwise(F.array().cast(SPANS))


# The kinds that are looked for, in the order in which spans at one place are listed.
# Maximal runs decide hex and access, so their least length may stand in the pattern.
RULES = (
    Rule(
        "assign",
        r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        8,
    ),
    Rule("access", r"AKIA[A-Z0-9]{12,}", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32),
)


def _ledger(spark: SparkSession, folder: str) -> DataFrame:
    runs = list_files(spark, f"{folder}/run-*/_SUCCESS")
    if not runs:
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(*[r.rsplit("/", 1)[0] for r in runs])


def scan_versions(
    versions: DataFrame, paths: list[str], ledger: str, rules: tuple[Rule, ...] = RULES, text_col: str = "text"
) -> DataFrame:
    """The columns ``paths`` of every version, its ``blob`` and one array of spans for each rule, named by its kind.

    Writes the ledger first: the pairs of blob and rule version that it lacks are scanned and added.
    """
    spark = versions.sparkSession
    names = [F.col(f"`{p}`") for p in paths]
    texts = versions.select(*names, whole_text(text_col).alias("_text"))
    texts = texts.withColumn("blob", F.sha2("_text", 256))
    present = reduce(lambda a, b: a | b, [(F.col("rule") == r.kind) & (F.col("version") == r.version) for r in rules])

    known = _ledger(spark, ledger).where(present)
    if known.head(1):
        # Addresses first: one bit for each rule that has seen a blob. Only texts of blobs with a bit missing go on.
        bits = reduce(lambda a, b: a.when(*b), [(F.col("rule") == r.kind, 1 << i) for i, r in enumerate(rules)], F)
        seen = known.groupBy(F.unhex("blob").alias("_of")).agg(F.bit_or(bits).alias("_seen"))
        wanted = texts.select(F.unhex("blob").alias("_of")).distinct().join(seen, "_of", "left")
        wanted = wanted.withColumn("_seen", F.coalesce("_seen", F.lit(0))).where(F.col("_seen") < (1 << len(rules)) - 1)
        wanted = stored(wanted, f"{ledger}/wanted-{uuid.uuid4().hex}")
        blobs = texts.select("blob", "_text", F.unhex("blob").alias("_of")).join(wanted, "_of")
        blobs = blobs.select("blob", "_text", "_seen").distinct()
    else:
        blobs = texts.select("blob", "_text").distinct().withColumn("_seen", F.lit(0))
    todo = []
    for i, r in enumerate(rules):
        unseen = F.col("_seen").bitwiseAND(1 << i) == 0
        row = F.struct(
            F.lit(r.kind).alias("rule"), F.lit(r.version).alias("version"), r.spans(F.col("_text")).alias("spans")
        )
        todo.append(F.when(unseen, row))
    found = blobs.select("blob", F.explode(F.array(*todo)).alias("_f")).where(F.col("_f").isNotNull())
    found.select("blob", "_f.*").write.parquet(f"{ledger}/run-{uuid.uuid4().hex}")

    # Two runs side by side may both have scanned a pair; their spans agree. Blobs without any span need no join.
    spans = _ledger(spark, ledger).where(present & (F.size("spans") > 0)).groupBy(F.col("blob").alias("_of"))
    spans = spans.agg(*[F.max(F.when(F.col("rule") == r.kind, F.col("spans"))).alias(r.kind) for r in rules])
    at = texts.select(*names, "blob").join(dealt_anew(spans, "_of"), F.col("blob") == F.col("_of"), "left")
    none = F.array().cast(SPANS)
    return at.select(*names, "blob", *[F.coalesce(F.col(r.kind), none).alias(r.kind) for r in rules])


def listed(kinds: list[str]) -> Column:
    """All spans as ``kind:start:stop`` by start, then kind as listed, joined by commas."""
    def marked(kind: str, order: int) -> Column:
        return F.transform(
            kind, lambda s: F.struct(s["start"].alias("a"), F.lit(order).alias("k"), s["stop"].alias("b"))
        )

    names = F.array(*[F.lit(k) for k in kinds])
    texts = F.transform(
        F.array_sort(F.concat(*[marked(k, i) for i, k in enumerate(kinds)])),
        lambda s: F.concat_ws(":", F.get(names, s["k"]), s["a"].cast("string"), s["b"].cast("string")),
    )
    return F.array_join(texts, ",")
