"""A keyed target table: upsert and delete by primary key on plain parquet.

Layout, all written by Spark's own writers::

    <path>/log/...      one folder per applied batch, one row per key
    <path>/base/...     one folder per full compaction, one row per key, bucketed by key
    <path>/commits      one small file per commit, written last and never changed

A batch costs as much as its own changes: it is reduced to one row per key and
added as a log folder. Readers lay the log folders that commits name over the
base: the base without the keys that the log has newer, and the log's winners.
The base is bucketed and only scanned, so a merge shuffles the changes only, and a
filter reaches its scan. Rows carry their position in the source's log (``_seq``),
the time of their write (``_write``) for changes at one position, and a tombstone flag
(``_deleted``), so the result does not depend on how the log was cut into batches
or in which order they came, and of writes at one position the last wins.

A delete by condition is a range tombstone: a commit with a condition, a position and no rows. The last
change of a key that is older and meets the condition counts as deleted, also one that arrives after the
commit. It stays a row with its own position, so an older change of its key cannot come back, and a
change between it and the tombstone that does not meet the condition still wins. A truncation is the tombstone without a condition.

A stream writes the changes of all its tables at once (``streaming.multi_log``). The folder of such a batch lies beside the
tables, has a part for each and holds images as VARIANT; commits name the part, and it is read in the columns of the table.

Commits say between which values of the first key column a log folder's and the base's rows lie, and base files are sorted by key
in pages of few rows. So a merge passes base rows outside the log's values by without a join, and ``read_keys`` reads
the pages around the keys it is asked for, in the base and in those log folders that may hold them; a few keys, wherever
they lie, are looked up by value.

A table may be opened with another schema than it was written with: columns that a file does
not have are NULL, those that are not asked for are not read.

``compact`` folds the log folders into one, or writes a new base. Its commit lists the
commits it covers. A commit that it does not list counts whenever it was written, so a
writer may take as long as it likes while others compact. Files that no commit needs any more
are removed by ``vacuum`` once they are old enough for no reader to use them.
"""

from __future__ import annotations

import hashlib
import json
import re
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.operators.latest import latest_per_key
from tablesync.sources.change_events import SEQ_TYPE
from tablesync.sources.files import delete_folder, folder_size, list_files, list_with_age, publish_text, read_text
from tablesync.spec import TableSpec

# Defaults of a table's parameters. The base starts with so many buckets, and their count doubles until
# a bucket, which one task reads, has at most twice ``bucket_bytes``.
FIRST_BUCKETS = 16
BUCKET_BYTES = 512 << 20
# ``compact`` writes a new base once the log has this share of the base's bytes, so each byte is
# rewritten a few times only; before, it folds the log.
REWRITE_SHARE = 0.25
# Rows of a page of a base file, the least that a filter on the key reads.
PAGE_ROWS = 4096
# A merge joins the base only between the log's key values where these are less than this share of the base's.
NARROW_SHARE = 0.5
# Rows of a base from which on the join that is saved costs more than a second scan's start.
NARROW_ROWS = 1_000_000
# How long a reader or writer may use files that a later commit has replaced.
RETAIN_SECONDS = 7 * 24 * 3600
# Commit files that a compaction covers are only in the way of a reader that listed them just before.
COMMIT_GRACE_SECONDS = 3600


# The form of a log folder that holds images of rows, see ``streaming.multi_log``.
IMAGES = "images"


@dataclass
class TableState:
    """What the commits say. Bounded by the batches since the last compaction."""

    fields: tuple[str, ...] = ()
    exists: bool = False
    number: int = 0
    files: list[str] = field(default_factory=list)
    base: dict | None = None
    logs: list[dict] = field(default_factory=list)
    ranges: list[dict] = field(default_factory=list)
    # With a lane, the last position in each; see ``KeyedTable``.
    lanes: dict[str, list] = field(default_factory=dict)
    last_by_label: dict[str, dict] = field(default_factory=dict)
    last_seq: dict | None = None
    last_write: int = 0

    def add(self, commit: dict) -> None:
        if commit["kind"] != "log":
            return
        if commit["folder"]:
            self.logs.append({k: commit.get(k) for k in ("folder", "first_seq", "last_seq", "form", "lanes", "zone")})
        for lane, (_, last) in (commit.get("lanes") or {}).items():
            self.lanes[lane] = max(last, self.lanes.get(lane, last))
        for i, r in enumerate(commit.get("ranges") or ()):
            self.ranges.append({**r, "write": commit["write"], "id": f"{commit['label']}/{commit['batch_id']}/{i}"})
        known = self.last_by_label.get(commit["label"])
        if known is None or commit["batch_id"] > known["batch_id"]:
            self.last_by_label[commit["label"]] = commit
        if self.after(commit["last_seq"], self.last_seq):
            self.last_seq = commit["last_seq"]
        self.last_write = max(self.last_write, commit["write"])

    @property
    def late_changes(self) -> bool:
        """Whether the log may hold a change that is older than the base's row."""
        if self.base is None or self.base["last_seq"] is None:
            return False
        lanes = self.base.get("lanes")
        if lanes is not None and all(log.get("lanes") is not None for log in self.logs):
            return any(lane in lanes and first <= lanes[lane] for log in self.logs for lane, (first, _) in log["lanes"].items())
        first = [log["first_seq"] for log in self.logs if log["first_seq"] is not None]
        return any(not self.after(seq, self.base["last_seq"]) for seq in first)

    @property
    def pending(self) -> list[dict]:
        """Range tombstones that the base's rows have not met."""
        applied = set((self.base or {}).get("applied", ()))
        return [r for r in self.ranges if r["id"] not in applied]

    def place(self, seq: dict) -> tuple:
        """A position as commits hold it, in order; a field it was written without counts as 0."""
        return tuple(seq.get(name, 0) for name in self.fields)

    def after(self, a: dict | None, b: dict | None) -> bool:
        """Whether position ``a`` is later than ``b``."""
        return a is not None and (b is None or self.place(a) > self.place(b))


class KeyedTable:
    """A keyed table below ``path``.

    ``lane`` is a field of the positions whose values count by themselves, as the partitions of a topic do: the table then
    keeps a last position for each, and a change is late only if it is so in its own lane. All changes of a key are in one lane.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        keys: list[str] | tuple[str, ...],
        buckets: int | None = None,
        seq_type: str = SEQ_TYPE,
        bucket_bytes: int = BUCKET_BYTES,
        rewrite_share: float = REWRITE_SHARE,
        lane: str | None = None,
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self.keys = list(keys)
        self.buckets = buckets or FIRST_BUCKETS
        self.seq_type = T.DataType.fromDDL(seq_type)
        self.bucket_bytes = bucket_bytes
        self.rewrite_share = rewrite_share
        self.lane = lane
        self._commits: dict[str, dict] = {}

    @classmethod
    def of(cls, spark: SparkSession, root: str, spec: TableSpec, **options) -> KeyedTable:
        return cls(spark, f"{root.rstrip('/')}/{spec.target}", spec.target_schema(), spec.keys, **options)

    # -- state ---------------------------------------------------------------

    def state(self) -> TableState:
        """One listing, and the commit files not read before."""
        files = [f.rsplit("/", 1)[1] for f in list_files(self.spark, f"{self.path}/commits/*.json")]
        try:
            self._commits = {f: self._commits.get(f) or self._read_commit(f) for f in files}
        except Exception:
            # A commit that a compaction covers may be removed after the listing; any other stays.
            listed = {f.rsplit("/", 1)[1] for f in list_files(self.spark, f"{self.path}/commits/*.json")}
            if listed >= set(files):
                raise
            return self.state()
        done = [(c["number"], f) for f, c in self._commits.items() if c["kind"] == "compaction"]
        state, covered = TableState(tuple(self.seq_type.names), exists=bool(files), files=files), set()
        if done:
            newest = self._commits[max(done)[1]]
            covered = set(newest["covers"])
            state.number, state.base, state.logs = newest["number"], newest["base"], list(newest["logs"])
            state.ranges, state.lanes = list(newest.get("ranges", ())), dict(newest.get("lanes", {}))
            state.last_by_label = dict(newest["labels"])
            state.last_seq, state.last_write = newest["last_seq"], newest["last_write"]
        for f in files:
            if f not in covered:
                state.add(self._commits[f])
        return state

    def _read_commit(self, name: str) -> dict:
        return json.loads(read_text(self.spark, f"{self.path}/commits/{name}"))

    def _commit(self, row: dict) -> None:
        """One file, made visible by one rename; names sort by time."""
        now = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S.%f")
        text = json.dumps({**row, "committed_at": now})
        publish_text(self.spark, f"{self.path}/commits", f"{now}-{uuid.uuid4().hex[:8]}.json", text)

    def exists(self) -> bool:
        return self.state().exists

    def create(self) -> bool:
        """Make the empty table if it is missing; says whether it did."""
        if self.exists():
            return False
        self._commit({"kind": "create"})
        return True

    # -- write ---------------------------------------------------------------

    def apply(
        self,
        changes: DataFrame,
        label: str,
        batch_id: int,
        before_commit: Callable[[], dict] | None = None,
        truncated_at: dict | None = None,
    ) -> dict:
        """Apply rows with the table's columns, ``_op`` (upsert or delete) and ``_seq``.

        The batch ids of a label must grow: one that is not above the last applied
        is skipped, so a restarted query may repeat its last batch; a repeat of the
        last one returns what its commit says. ``before_commit`` is called once the rows
        are written; what it returns is kept in the commit as ``notes``. ``truncated_at`` is the
        position of a truncation in the batch.
        """
        state = self.state()
        if (skipped := skipped_batch(state, label, batch_id)) is not None:
            return skipped

        write = self.next_write(state)
        rows = latest_per_key(self._stored(changes, write), self.keys, "_seq")
        # Counted behind the last shuffle, where a task that is run again counts once.
        counts = Observation()
        rows = rows.observe(
            counts,
            F.count_if(~F.col("_deleted")).alias("upserts"),
            F.count_if("_deleted").alias("deletes"),
            F.min("_seq").alias("first_seq"),
            F.max("_seq").alias("last_seq"),
            *self._zone_ends(),
        )
        folder = f"log/{re.sub(r'[^A-Za-z0-9_.-]', '_', label)}-{batch_id}-{uuid.uuid4().hex[:8]}"
        rows.write.parquet(f"{self.path}/{folder}")

        seen = counts.get
        return self.commit_log(
            state,
            label,
            batch_id,
            write,
            folder=folder,
            upserts=seen["upserts"] or 0,
            deletes=seen["deletes"] or 0,
            first_seq=json_position(seen["first_seq"]),
            last_seq=json_position(seen["last_seq"]),
            lanes=self._lanes(folder),
            zone=_json_zone(seen),
            notes=before_commit() if before_commit else None,
            ranges=[] if truncated_at is None else [{"condition": None, "seq": truncated_at}],
        )

    def _zone_ends(self) -> list[Column]:
        first = F.col(f"`{self.keys[0]}`")
        return [f(first).cast("string").alias(n) for f, n in ((F.min, "low"), (F.max, "high"))]

    def _within(self, zone: list[str] | tuple | None) -> Column:
        """Whether the first key column lies in a zone; everything lies in none."""
        if zone is None:
            return F.lit(True)
        kind, first = self.schema[self.keys[0]].dataType, F.col(f"`{self.keys[0]}`")
        return (first >= F.lit(zone[0]).cast(kind)) & (first <= F.lit(zone[1]).cast(kind))

    def _narrow(self, state: TableState) -> list[str] | None:
        """The zone of all logs, if it is known and much narrower than the base's."""
        zones = [log.get("zone") for log in state.logs]
        base = state.base.get("zone")
        if base is None or state.base["rows"] < NARROW_ROWS or None in zones or not isinstance(self.schema[self.keys[0]].dataType, T.NumericType):
            return None
        low, high = min((z[0] for z in zones), key=Decimal), max((z[1] for z in zones), key=Decimal)
        inner = min(Decimal(high), Decimal(base[1])) - max(Decimal(low), Decimal(base[0]))
        return [low, high] if inner < (Decimal(base[1]) - Decimal(base[0])) * Decimal(NARROW_SHARE) else None

    def _lanes(self, folder: str) -> dict[str, list] | None:
        """The first and last position of each lane in a log folder, as lists of the fields."""
        if self.lane is None:
            return None
        rows = self.spark.read.schema(T.StructType().add("_seq", self.seq_type)).parquet(f"{self.path}/{folder}")
        seen = rows.groupBy(f"_seq.{self.lane}").agg(F.min("_seq").alias("first"), F.max("_seq").alias("last")).collect()
        return {str(r[0]): [list(r["first"]), list(r["last"])] for r in seen}

    def commit_log(self, state: TableState, label: str, batch_id: int, write: int, **what) -> dict:
        """Make a batch count whose rows, if it has any, are written."""
        places = [what["last_seq"], *(r["seq"] for r in what["ranges"])]
        for seq in places:
            what["last_seq"] = seq if state.after(seq, what["last_seq"]) else what["last_seq"]
        self._commit({"kind": "log", "label": label, "batch_id": batch_id, "write": write, **what})
        return {"upserts": what["upserts"], "deletes": what["deletes"], "skipped": False, "notes": what["notes"]}

    def delete_where(self, condition: str, label: str, batch_id: int, position: dict | None = None) -> dict:
        """Delete the rows that meet a condition, SQL over the table's columns, as they stand at a log position.

        ``position`` is the last one the table has seen, if none is given. The commit reads and writes no
        row; changes that are newer than the position stay, older ones that arrive late are judged as well.
        """
        test = self.spark.createDataFrame([], self.schema).select(F.expr(condition).alias("test"))
        if test.schema["test"].dataType != T.BooleanType():
            raise ValueError(f"{condition} is no condition")
        return self._delete_range(condition, label, batch_id, position)

    def truncate(self, label: str, batch_id: int, position: dict | None = None) -> dict:
        """Delete all rows as they stand at a log position, see ``delete_where``."""
        return self._delete_range(None, label, batch_id, position)

    def _delete_range(self, condition: str | None, label: str, batch_id: int, position: dict | None) -> dict:
        state = self.state()
        if (skipped := skipped_batch(state, label, batch_id)) is not None:
            return skipped
        seq = self._full_position(position, state)
        none = dict.fromkeys(("folder", "first_seq", "last_seq", "notes"))
        ranges = [{"condition": condition, "seq": seq}]
        return self.commit_log(state, label, batch_id, self.next_write(state), **none, upserts=0, deletes=0, ranges=ranges)

    def next_write(self, state: TableState) -> int:
        return max(int(time.time() * 1e6), state.last_write + 1)

    def _full_position(self, at: dict | None, state: TableState) -> dict:
        """A position with all fields: that of the last epoch, if it names none, and 0 for what is missing."""
        last = state.last_seq or {}
        at = at or last
        at = {**({"epoch": last.get("epoch", 0)} if "epoch" in self.seq_type.names else {}), **at}
        return {f.name: at.get(f.name, 0 if isinstance(f.dataType, T.NumericType) else None) for f in self.seq_type.fields}

    def position(self, at: dict | None = None) -> Column:
        """``_seq`` for rows without one: the given position, or the last one the table has seen."""
        at = self._full_position(at, self.state())
        fields = [F.lit(at.get(f.name)).cast(f.dataType) for f in self.seq_type.fields]
        zero = [F.lit(0).cast(f.dataType) if isinstance(f.dataType, T.NumericType) else F.lit(None) for f in self.seq_type.fields]
        return F.struct(
            *[F.coalesce(v, z).cast(f.dataType).alias(f.name) for v, z, f in zip(fields, zero, self.seq_type.fields, strict=True)]
        )

    def _stored(self, changes: DataFrame, write: int) -> DataFrame:
        """The stored columns, matched by name; a delete keeps only its key."""
        gone = F.col("_op") == "delete"
        columns = []
        for f in self.schema.fields:
            value = F.col(f"`{f.name}`")
            value = value if f.name in self.keys else F.when(~gone, value)
            columns.append(value.cast(f.dataType).alias(f.name))
        no_position = F.raise_error(F.lit(f"a change of {self.path} has no position")).cast(self.seq_type)
        seq = F.coalesce(self._place(changes), no_position)
        return changes.select(*columns, seq.alias("_seq"), F.lit(write).alias("_write"), gone.alias("_deleted"))

    def _place(self, rows: DataFrame) -> Column:
        """``_seq`` in the table's type; a field that it was written without is 0."""
        given = rows.schema["_seq"].dataType
        if given == self.seq_type or not isinstance(given, T.StructType):
            value = F.col("_seq").cast(self.seq_type)
        elif set(given.names) - set(self.seq_type.names):
            # Other names: the fields in their order.
            given = [f"_seq.`{n}`" for n in given.names]
            given = [F.lit(0)] * (len(self.seq_type.names) - len(given)) + [F.col(n) for n in given]
            fields = [v.cast(f.dataType).alias(f.name) for v, f in zip(given, self.seq_type.fields, strict=True)]
            value = F.when(F.col("_seq").isNotNull(), F.struct(*fields))
        else:
            fields = []
            for f in self.seq_type.fields:
                value = F.col(f"_seq.{f.name}") if f.name in given.names else F.lit(0)
                fields.append(value.cast(f.dataType).alias(f.name))
            value = F.when(F.col("_seq").isNotNull(), F.struct(*fields))
        if "epoch" in self.seq_type.names:
            # Rows written before there were epochs.
            value = value.withField("epoch", F.coalesce(value["epoch"], F.lit(0).cast("bigint")))
        return value

    def _marked(self, rows: DataFrame, ranges: list[dict]) -> DataFrame:
        """Rows that a range tombstone covers as deletes, at their own positions."""
        if not ranges:
            return rows
        order, tests = F.struct("_seq", "_write"), []
        for r in ranges:
            seq = F.struct(*[F.lit(r["seq"].get(f.name, 0)).cast(f.dataType).alias(f.name) for f in self.seq_type.fields])
            older = order < F.struct(seq.alias("_seq"), F.lit(r["write"]).cast("bigint").alias("_write"))
            tests.append(older & (F.coalesce(F.expr(r["condition"]), F.lit(False)) if r["condition"] else F.lit(True)))
        gone = F.col("_deleted") | reduce(lambda a, b: a | b, tests)
        rest = [f.name for f in self.schema.fields if f.name not in self.keys]
        # The test is made before the columns it reads are emptied.
        rows = rows.withColumn("_gone", gone)
        return rows.withColumns({**{n: F.when(~F.col("_gone"), F.col(f"`{n}`")) for n in rest}, "_deleted": F.col("_gone")}).drop("_gone")

    # -- read ----------------------------------------------------------------

    def read(self, with_deleted: bool = False) -> DataFrame:
        """The live rows, merged from the base and the batches applied since."""
        rows = self._merged(self.state())
        if with_deleted:
            return rows
        return rows.where(~F.col("_deleted")).select(*[F.col(f"`{n}`") for n in self.schema.names])

    def read_keys(self, keys: DataFrame) -> DataFrame:
        """The live rows of some keys, the key columns of ``keys``, from the parts of the table around them."""
        state, wanted = self.state(), keys.select(*[F.col(f"`{k}`").cast(self.schema[k].dataType).alias(k) for k in self.keys])
        ends = wanted.agg(*self._zone_ends()).first()
        if ends["low"] is None:
            return self.read().limit(0)
        zone = [ends["low"], ends["high"]]
        kind = self.schema[self.keys[0]].dataType
        if isinstance(kind, T.NumericType):
            state.logs = [log for log in state.logs if log.get("zone") is None or _overlap(log["zone"], zone)]
        # As many values as Spark hands to the files one by one; more of them only as a zone.
        few = int(self.spark.conf.get("spark.sql.parquet.pushdown.inFilterThreshold"))
        firsts = wanted.select(F.col(f"`{self.keys[0]}`").alias("k")).where("k IS NOT NULL").distinct().limit(few + 1).collect()
        values = [r.k for r in firsts] if len(firsts) <= few else None
        rows = self._merged(state, zone=zone, values=values).join(wanted.distinct(), self.keys, "left_semi")
        return rows.where(~F.col("_deleted")).select(*[F.col(f"`{n}`") for n in self.schema.names])

    def _merged(
        self, state: TableState, partitions: int | None = None, zone: list[str] | None = None, values: list | None = None
    ) -> DataFrame:
        log, base = self._log(state, partitions), self._base(state)
        if zone is not None:
            wanted = self._within(zone) if values is None else F.col(f"`{self.keys[0]}`").isin(values)
            log, base = (rows if rows is None else rows.where(wanted) for rows in (log, base))
        if base is None or log is None:
            rows, ranges = (log, state.ranges) if base is None else (base, state.pending)
            return self.spark.createDataFrame([], self._stored_schema()) if rows is None else self._marked(rows, ranges)

        names = [f"_key{i}" for i in range(len(self.keys))]
        placed = [F.col(k).alias(n) for k, n in zip(self.keys, names, strict=True)]
        logged = log.select(*placed, F.struct("_seq", "_write").alias("_at"))
        if partitions:
            # A new base is written: it is read bucket by bucket, so that each has two files at most.
            logged = logged.hint("merge")
        same = reduce(lambda a, b: a & b, [F.col(k) == F.col(n) for k, n in zip(self.keys, names, strict=True)])
        order = F.struct("_seq", "_write")
        narrow = self._narrow(state) if partitions is None and zone is None else None
        # Rows outside the log's zone have no change, so they are not joined.
        outside = None if narrow is None else base.where(~self._within(narrow))
        base = base if narrow is None else base.where(self._within(narrow))
        kept = base.join(logged, same & (F.col("_at") >= order), "left_anti")
        kept = kept if outside is None else outside.unionByName(kept)
        if state.late_changes:
            # A second scan of the base, for its keys and positions only.
            late = base.select(*self.keys, "_seq", "_write").join(logged, same).where(order > F.col("_at"))
            log = log.join(late.select(*self.keys), self.keys, "left_anti")
        kept, log = self._marked(kept, state.pending), self._marked(log, state.ranges)
        return kept.unionByName(log).select(*self._stored_schema().names)

    def _log(self, state: TableState, partitions: int | None = None) -> DataFrame | None:
        """The last logged change of every key; with ``partitions``, distributed by key."""
        if not state.logs:
            return None
        folders = [f"{self.path}/{log['folder']}" for log in state.logs if log.get("form") != IMAGES]
        images = [log["folder"] for log in state.logs if log.get("form") == IMAGES]
        parts = []
        if folders:
            rows = self.spark.read.schema(self._stored_schema()).parquet(*folders)
            parts.append(rows.withColumn("_seq", self._place(rows)))
        if images:
            parts.append(self.image_rows(images).drop("_bad"))
        rows = reduce(DataFrame.unionByName, parts)
        if partitions:
            rows = rows.repartition(partitions, *self.keys)
        # One folder has one row per key.
        return latest_per_key(rows, self.keys, F.struct("_seq", "_write")) if len(state.logs) > 1 else rows

    def image_rows(self, folders: list[str], bad: bool = False) -> DataFrame:
        """The stored columns of image folders and ``_bad``: the good rows, or the bad ones."""
        schema = T.StructType().add("_seq", self.seq_type).add("_write", "long").add("_deleted", "boolean")
        schema = schema.add("_bad", "string").add("_image", T.VariantType())
        rows = self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in folders])
        rows = rows.where(F.col("_bad").isNotNull() if bad else F.col("_bad").isNull())
        kinds = {f.name: f.dataType.simpleString() for f in self.schema.fields}
        values = [F.variant_get("_image", f"$.{image_field(n)}", kind).alias(n) for n, kind in kinds.items()]
        return rows.select(*values, self._place(rows).alias("_seq"), "_write", "_deleted", "_bad")

    def _base(self, state: TableState) -> DataFrame | None:
        if state.base is None:
            return None
        name, place = self._base_name(state.base["folder"]), f"{self.path}/{state.base['folder']}"
        if not self.spark.catalog.tableExists(name):
            # The schema it was written with, which need not be the one it is read with.
            written = T.StructType.fromJson(state.base["schema"]) if "schema" in state.base else self.spark.read.parquet(place).schema
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in written)
            keys = ", ".join(f"`{k}`" for k in self.keys)
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY ({keys}) "
                f"SORTED BY ({keys}) INTO {state.base['buckets']} BUCKETS LOCATION '{place}'"
            )
        rows = self.spark.table(name)
        present, columns = {f.name: f.dataType for f in rows.schema.fields}, []
        for f in self._stored_schema().fields:
            if f.name == "_seq":
                value = self._place(rows)
            elif f.name not in present:
                value = F.lit(None).cast(f.dataType)
            else:
                value = F.col(f"`{f.name}`")
                value = value if present[f.name] == f.dataType else value.cast(f.dataType)
            columns.append(value.alias(f.name))
        return rows.select(*columns)

    def _base_name(self, folder: str) -> str:
        return f"tablesync_base_{hashlib.md5(f'{self.path}/{folder}'.encode()).hexdigest()[:24]}"

    def _stored_schema(self) -> T.StructType:
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in self.schema.fields])
        return schema.add("_seq", self.seq_type).add("_write", T.LongType()).add("_deleted", T.BooleanType())

    # -- maintenance ---------------------------------------------------------

    def compact(self, full: bool | None = None, drop_deleted: bool = False, buckets: int | None = None) -> bool:
        """The same rows in fewer files; says whether there was a log.

        ``full`` writes a new base, else the log folders are folded into one; left
        open, the log's share of the bytes decides. Tombstones stay, those of ranges too, so that a late older
        event cannot bring a row back; ``drop_deleted`` removes them in a full run, once no
        older event can arrive any more. Streams and back-fills go on meanwhile.
        """
        state = self.state()
        if not state.logs and not (state.pending and state.base and full is not False):
            return False
        log_bytes = sum(folder_size(self.spark, f"{self.path}/{log['folder']}") for log in state.logs)
        base_bytes = 0 if state.base is None else folder_size(self.spark, f"{self.path}/{state.base['folder']}")
        if full is None:
            full = state.base is None or drop_deleted or not state.logs or log_bytes >= self.rewrite_share * base_bytes

        name = f"{state.number + 1}-{uuid.uuid4().hex[:8]}"
        base, logs = state.base, []
        if full:
            folder, count = f"base/{name}", buckets or self._bucket_count(state, log_bytes + base_bytes)
            present = state.base["buckets"] if state.base else count
            rows = self._merged(state, present)
            if count != present:
                rows = rows.repartition(count, *self.keys)
            if drop_deleted:
                rows = rows.where(~F.col("_deleted"))
            seen = Observation()
            (
                rows.observe(seen, F.count(F.lit(1)).alias("n"), *self._zone_ends())
                .write.format("parquet")
                .option("parquet.page.row.count.limit", PAGE_ROWS)
                .bucketBy(count, *self.keys)
                .sortBy(*self.keys)
                .option("path", f"{self.path}/{folder}")
                .saveAsTable(self._base_name(folder))
            )
            if drop_deleted:
                state.ranges = []
            schema = json.loads(self._stored_schema().json())
            applied = [r["id"] for r in state.ranges]
            base = {"folder": folder, "buckets": count, "last_seq": state.last_seq, "schema": schema, "applied": applied}
            base["zone"], base["rows"] = _json_zone(seen.get), seen.get["n"]
            if self.lane is not None:
                base["lanes"] = state.lanes
        else:
            folder = f"log/folded-{name}"
            self._log(state).write.parquet(f"{self.path}/{folder}")
            first = [log["first_seq"] for log in state.logs if log["first_seq"] is not None]
            least = min(first, key=state.place) if first else None
            zones = [log.get("zone") for log in state.logs]
            numeric = isinstance(self.schema[self.keys[0]].dataType, T.NumericType)
            zone = [f((z[i] for z in zones), key=Decimal) for i, f in enumerate((min, max))] if numeric and None not in zones else None
            logs = [
                {"folder": folder, "first_seq": least, "last_seq": state.last_seq, "lanes": self._lanes(folder), "zone": zone}
            ]
        self._commit(
            {
                "kind": "compaction",
                "number": state.number + 1,
                "covers": state.files,
                "base": base,
                "logs": logs,
                "ranges": state.ranges,
                "lanes": state.lanes,
                "labels": state.last_by_label,
                "last_seq": state.last_seq,
                "last_write": state.last_write,
            }
        )
        return True

    def _bucket_count(self, state: TableState, size: int) -> int:
        """The present count, doubled until no bucket is twice too large or Spark allows no more."""
        count = state.base["buckets"] if state.base else self.buckets
        most = int(self.spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
        while size > 2 * self.bucket_bytes * count and 2 * count <= most:
            count *= 2
        return count

    def vacuum(self, retain_seconds: float = RETAIN_SECONDS, grace_seconds: float = COMMIT_GRACE_SECONDS) -> list[str]:
        """Delete folders that no commit needs and commit files that a compaction covers, once they are old enough.

        A folder without a commit may be a writer's that has not ended; it counts as
        used until it is ``retain_seconds`` old.
        """
        state = self.state()
        used = {log["folder"] for log in state.logs} | ({state.base["folder"]} if state.base else set())
        gone = []
        for path, age in list_with_age(self.spark, f"{self.path}/log/*") + list_with_age(self.spark, f"{self.path}/base/*"):
            folder = "/".join(path.rsplit("/", 2)[1:])
            if folder not in used and age >= retain_seconds:
                if folder.startswith("base/"):
                    self.spark.sql(f"DROP TABLE IF EXISTS {self._base_name(folder)}")
                delete_folder(self.spark, path)
                gone.append(folder)
        newest = max(((c["number"], f) for f, c in self._commits.items() if c["kind"] == "compaction"), default=None)
        covered = set(self._commits[newest[1]]["covers"]) if newest else set()
        for path, age in list_with_age(self.spark, f"{self.path}/commits/*.json"):
            if path.rsplit("/", 1)[1] in covered and age >= grace_seconds:
                delete_folder(self.spark, path)
        return sorted(gone)


def _json_zone(seen: dict) -> list[str] | None:
    return None if seen["low"] is None else [seen["low"], seen["high"]]


def _overlap(a: list[str], b: list[str]) -> bool:
    return Decimal(a[0]) <= Decimal(b[1]) and Decimal(b[0]) <= Decimal(a[1])


def image_field(column: str) -> str:
    """A column's name in an image, where paths take letters, digits and underscores only."""
    return "f" + "".join(c if c.isascii() and c.isalnum() else f"_{ord(c):x}_" for c in column)


def skipped_batch(state: TableState, label: str, batch_id: int) -> dict | None:
    """What a batch's commit says, if the batch or a later one of its label is applied."""
    known = state.last_by_label.get(label)
    if known is None or batch_id > known["batch_id"]:
        return None
    told = known if batch_id == known["batch_id"] else {}
    return {"upserts": told.get("upserts", 0), "deletes": told.get("deletes", 0), "skipped": True, "notes": told.get("notes")}


def json_position(seq) -> dict | None:
    if seq is None:
        return None
    return {k: v if isinstance(v, (int, float, str, type(None))) else str(v) for k, v in seq.asDict().items()}
