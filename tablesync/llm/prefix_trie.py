"""Trie of the prefixes of conversations, with totals of subtrees by time-forward processing.

A node is a distinct sequence of first turns; conversations that begin with it are its members.

* **Turns in order.** All turns are range-sorted by conversation and place, so a conversation of any length is spread over
  tasks. The name of a prefix is the value, modulo 2^127 - 1, of the polynomial whose coefficients are the
  SHA-256 names of its turns. A task computes it from its own first turn on, and a conversation that goes on from one task into the next
  takes the value with it: the driver sees two rows for each partition.
* **Nodes.** Members are counted by (depth, name), reduced before the shuffle. Members of a node that differ in their last turn or
  in their parent would be two prefixes under one name; that stops the job. A node is known from then on by its smallest member and its
  depth, and nodes of one smallest member are a path.
* **Totals, time-forward.** Nodes are dealt into shards of ``WIDTH`` conversations by ``HEIGHT`` depths, so a shard is small however many
  turns a conversation or children a node has. In a shard nodes come in reverse level order, by an external sort;
  a node takes the totals of its children from a priority queue and puts its own there for its parent. The queue spills sorted runs to a
  file of the task. What is left are the shard roots, whose parents lie in other shards: those that wait for nothing are summed by parent, the others
  are the nodes of a smaller trie, which is treated in the same way with wider shards. Their totals then go back to
  the shards that waited for them.
* **Ends.** The ids of the conversations that end at a node are range-sorted, joined into segments of 16 KB, and only segments of one
  node are hashed one after another, as SHA-256 has it.

Tables between the steps lie in the shared folder. A task's spill file has no name and no other reader; a lost task starts anew.

Defined cases: turns are ordered by their number, null first, turns of one number by the SHA-256 of role and text; repeated rows are
turns each; a null or empty role or text is empty; rows without a conversation's id are no conversation's and are left out; an empty
table has no node, not even the root; other columns are not read, whatever their names. Very long texts are hashed where they are read and go no further.
"""

from __future__ import annotations

import hashlib
import heapq
import struct
import tempfile
from collections.abc import Iterator
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablesync.llm.graph import stored
from tablesync.session import run_folder

PRIME = (1 << 127) - 1
# The point at which the polynomials are taken; any number of that size does.
POINT = int.from_bytes(hashlib.sha256(b"prefixes of conversations").digest()[:15], "big")
WIDTH, HEIGHT = 1000, 128
# How much wider the shards of a smaller trie are, and how many nodes need no shards.
WIDER = 32
ONE_SHARD = 10_000
# Entries of a priority queue in memory, bytes of a segment of ids.
QUEUE_ENTRIES = 1 << 16
SEGMENT = 1 << 14
# A parent with more than this share of all lookups is looked up in a broadcast table, which so has fewer rows than that.
HOT_SHARE = 4096
HEADS = 6
MARKER, HEAD, OWN = 0, 1, 2
PLACE = ("conv_id", "kind", "turn", "tie", "row")


class SpillingQueue:
    """A priority queue of (level, conversation, leaves, saved), the smallest first, that keeps few entries in memory."""

    def __init__(self, most: int = QUEUE_ENTRIES):
        self.most = most
        self.heap: list[tuple[int, int, int, int]] = []
        self.runs: list[tuple[tuple[int, int, int, int], int, Iterator]] = []
        self.spilled = 0

    def _spill(self) -> None:
        file, entry = tempfile.TemporaryFile(), struct.Struct("<4q")
        for item in sorted(self.heap):
            file.write(entry.pack(*item))
        file.seek(0)
        self.heap = []

        def read() -> Iterator[tuple]:
            with file:
                while block := file.read(entry.size * 1024):
                    yield from entry.iter_unpack(block)

        self.spilled += 1
        self._advance(read(), self.spilled)

    def _advance(self, run: Iterator, number: int) -> None:
        item = next(run, None)
        if item is not None:
            heapq.heappush(self.runs, (item, number, run))

    def push(self, item: tuple[int, int, int, int]) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.most:
            self._spill()

    def head(self) -> tuple[int, int, int, int] | None:
        heads = [*self.heap[:1], *(r[0] for r in self.runs[:1])]
        return min(heads) if heads else None

    def pop(self) -> tuple[int, int, int, int]:
        if self.runs and (not self.heap or self.runs[0][0] < self.heap[0]):
            item, number, run = heapq.heappop(self.runs)
            self._advance(run, number)
            return item
        return heapq.heappop(self.heap)


def _batch(rows: list[tuple], names: list[str], kinds: list):
    import pyarrow as pa

    columns = zip(*rows, strict=True) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _schema(schema: str) -> tuple[list[str], list]:
    import pyarrow as pa

    kinds = {"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}
    pairs = [c.split() for c in schema.split(", ")]
    return [n for n, _ in pairs], [kinds[k] for _, k in pairs]


def _turns(conversations: DataFrame) -> DataFrame:
    """One narrow row for each turn: its place, the name of its role and text, and the code points of the text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    name = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))
    return conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.lit(OWN).alias("kind"),
        F.col("turn").cast("long").alias("turn"),
        name.alias("tie"),
        F.monotonically_increasing_id().alias("row"),
        F.length(text).cast("long").alias("points"),
    )


def _markers(turns: DataFrame) -> DataFrame:
    """A row for each conversation, before its turns."""
    ids = turns.select("conv_id").distinct()
    none = [F.lit(None).cast(k).alias(c) for c, k in (("turn", "long"), ("tie", "binary"), ("row", "long"))]
    return ids.select("conv_id", F.lit(MARKER).alias("kind"), *none, F.lit(0).cast("long").alias("points"))


def conversation_turns(conversations: DataFrame, folder: str) -> DataFrame:
    """Rows for ``trie`` from ``conversations`` (conv_id, turn, role, text) as they are."""
    turns = stored(_turns(conversations), f"{folder}/turns")
    return _markers(turns).unionByName(turns)


def rebuilt_turns(conversations: DataFrame, folder: str, block: int = 100, heads: int = HEADS) -> DataFrame:
    """Rows for ``trie`` from conversations that begin like another one.

    A conversation's first h turns are replaced by those of the first conversation of its block of
    ``block`` ids; h is the CRC-32 of its id modulo ``heads``.
    """
    turns = stored(_turns(conversations), f"{folder}/turns")
    markers = _markers(turns)
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(heads))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "tie", "row")
    first = turns.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= heads - 1)
    first = stored(first.select("conv_id", "tie", "row", "points", F.col("rank").cast("long").alias("rank")), f"{folder}/first")
    replaced = first.where(F.col("rank") <= h).select("row")
    base = F.col("conv_id") - F.col("conv_id") % block
    taken = markers.select("conv_id", h.alias("h"), base.alias("base"))
    given = first.where(F.col("conv_id") % block == 0).withColumnRenamed("conv_id", "base")
    head = taken.join(given, "base").where(F.col("rank") <= F.col("h"))
    head = head.select("conv_id", F.lit(HEAD).alias("kind"), F.col("rank").alias("turn"), "tie", "row", "points")
    return markers.unionByName(head).unionByName(turns.join(replaced, "row", "left_anti"))


STEPS = (
    "part long, opened boolean, edge boolean, last boolean, conv_id long, k long, hi long, lo long, phi long, plo long, "
    "thi long, tlo long, points long"
)


def _halves(value: int) -> tuple[int, int]:
    low = value & (1 << 64) - 1
    return value >> 64, low - (1 << 64) if low >> 63 else low


def _whole(hi: int, lo: int) -> int:
    return hi << 64 | lo & (1 << 64) - 1


def _steps(rows: DataFrame) -> DataFrame:
    """The turns in order with the names of their prefixes from the conversation's first row in the partition on."""

    def run(batches: Iterator) -> Iterator:
        from pyspark import TaskContext

        names, kinds = _schema(STEPS)
        part, held, out = TaskContext.get().partitionId(), None, []
        conv, opened, k, value = None, False, 0, 0
        for batch in batches:
            for c, kind, tie, points in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if held is not None:
                    out.append((part, held[0], False, c != conv, *held[1:]))
                if c != conv:
                    conv, opened, k, value = c, kind != MARKER, 0, 0
                before, turn = value, 0
                if kind != MARKER:
                    turn = int.from_bytes(tie[:16], "big") % PRIME
                    k, value = k + 1, (value * POINT + turn) % PRIME
                held = (opened, conv, k, *_halves(value), *_halves(before), *_halves(turn), points)
            if len(out) >= 4096:
                yield _batch(out, names, kinds)
                out = []
        if held is not None:
            out.append((part, held[0], True, True, *held[1:]))
        if out:
            yield _batch(out, names, kinds)

    dealt = rows.repartitionByRange(*PLACE).sortWithinPartitions(*PLACE)
    return dealt.select("conv_id", "kind", "tie", "points").mapInArrow(run, STEPS)


def _members(steps: DataFrame) -> DataFrame:
    """``depth``, name, parent's name, last turn's name, ``points``, ``conv_id`` and ``ends`` for each prefix of each conversation."""
    # Two rows for each partition at most: its first conversation, if that began earlier, and its last one.
    some = steps.where("last AND (opened OR edge)").select("part", "opened", "edge", "conv_id", "k", "hi", "lo").collect()
    before: dict[int, tuple[int, int]] = {}
    goes_on, at = [], None
    for r in sorted(some, key=lambda r: (r["part"], r["edge"])):
        depth, value = r["k"], _whole(r["hi"], r["lo"])
        if r["opened"]:
            part, held_depth, held_value = at
            before[r["part"]] = held_depth, held_value
            goes_on.append(part)
            depth, value = held_depth + depth, (held_value * pow(POINT, depth, PRIME) + value) % PRIME
        if r["edge"]:
            at = r["part"], depth, value

    def run(batches: Iterator) -> Iterator:
        names, kinds = _schema(STEPS)
        for batch in batches:
            rows = []
            for r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                depth, value = before[r[0]]
                k, whole = r[5], []
                for power, hi, lo in ((k, *r[6:8]), (k - 1, *r[8:10])):
                    whole += _halves((value * pow(POINT, power, PRIME) + _whole(hi, lo)) % PRIME)
                rows.append((*r[:5], depth + k, *whole, *r[10:]))
            yield _batch(rows, names, kinds)

    goes_on = F.col("edge") & F.col("part").isin(goes_on) if goes_on else F.lit(False)
    every = steps.where("NOT opened").union(steps.where("opened").mapInArrow(run, STEPS))
    ends = (F.col("last") & ~goes_on).alias("ends")
    return every.select(F.col("k").alias("depth"), "hi", "lo", "phi", "plo", "thi", "tlo", "points", "conv_id", ends)


def _nodes(members: DataFrame) -> DataFrame:
    same = ("phi", "plo", "thi", "tlo", "points")
    ranges = [f(c).alias(f"{c}_{n}") for c in same for n, f in (("least", F.min), ("most", F.max))]
    found = members.groupBy("depth", "hi", "lo").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), *ranges)
    differ = reduce(lambda a, b: a | b, (F.col(f"{c}_least") != F.col(f"{c}_most") for c in same))
    checked = F.when(differ, F.raise_error(F.lit("two prefixes have one name")).cast("long")).otherwise(F.col("n_convs"))
    return found.select("depth", "hi", "lo", "conv_id", checked.alias("n_convs"), *(F.col(f"{c}_least").alias(c) for c in same[:2]), F.col("points_least").alias("points"))


def _parents(nodes: DataFrame) -> DataFrame:
    """``conv_id``, ``depth`` and ``pconv`` for the first node of each path, whose parent is on another one."""
    tops = nodes.groupBy("conv_id").agg(F.min(F.struct("depth", "phi", "plo")).alias("t"))
    tops = tops.where("t.depth > 0").select("conv_id", "t.depth", (F.col("t.depth") - 1).alias("pdepth"), "t.phi", "t.plo")
    known = nodes.select(F.col("depth").alias("pdepth"), F.col("hi").alias("phi"), F.col("lo").alias("plo"), F.col("conv_id").alias("pconv"))
    key = ["pdepth", "phi", "plo"]
    hot = tops.groupBy(*key).count().where(F.col("count") > max(1, tops.count() // HOT_SHARE)).select(*key)
    some = tops.join(F.broadcast(hot.join(known, key)), key, "left")
    rest = some.where("pconv IS NULL").drop("pconv").join(known, key)
    return some.where("pconv IS NOT NULL").unionByName(rest).select("conv_id", "depth", "pconv")


LOCAL = "conv_id long, depth long, pconv long, pdepth long, out boolean, leaves long, saved long, rconv long, rdepth long"


def _solve(rows: list[tuple], entries: int = QUEUE_ENTRIES) -> Iterator[tuple]:
    """A shard's nodes in reverse level order, with the totals below them and the shard root above them."""
    queue, done = SpillingQueue(entries), []
    for depth, conv, pdepth, pconv, out, leaves, saved in rows:
        while (head := queue.head()) is not None and head[:2] == (-depth, conv):
            _, _, more_leaves, more_saved = queue.pop()
            leaves, saved = leaves + more_leaves, saved + more_saved
        if not out:
            queue.push((-pdepth, pconv, leaves, saved))
        done.append((conv, depth, pconv, pdepth, out, leaves, saved))
    root: dict[tuple[int, int], tuple[int, int]] = {}
    for conv, depth, pconv, pdepth, out, leaves, saved in reversed(done):
        root[conv, depth] = at = (conv, depth) if out else root[pconv, pdepth]
        yield conv, depth, pconv, pdepth, out, leaves, saved, *at


def _in_shards(nodes: DataFrame, width: int, height: int, one: bool) -> DataFrame:
    """Totals within shards; ``out`` marks the shard roots."""

    def run(batches: Iterator) -> Iterator:
        names, kinds = _schema(LOCAL)
        shard, rows, out = None, [], []
        for batch in batches:
            for s, t, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (s, t) != shard:
                    out += _solve(rows)
                    shard, rows = (s, t), []
                    if len(out) >= 4096:
                        yield _batch(out, names, kinds)
                        out = []
                rows.append(tuple(row))
        out += _solve(rows)
        if out:
            yield _batch(out, names, kinds)

    def shard(conv: str, depth: str) -> list:
        return [F.lit(0).cast("long")] * 2 if one else [F.expr(f"{conv} div {width}"), F.expr(f"{depth} div {height}")]

    here, there = shard("conv_id", "depth"), shard("pconv", "pdepth")
    out = F.col("pconv").isNull() | (here[0] != there[0]) | (here[1] != there[1])
    dealt = nodes.select(here[0].alias("s"), here[1].alias("t"), "depth", "conv_id", "pdepth", "pconv", out.alias("out"), "leaves", "saved")
    dealt = dealt.repartition("s", "t").sortWithinPartitions("s", "t", F.desc("depth"), "conv_id")
    return dealt.mapInArrow(run, LOCAL)


def subtree_totals(nodes: DataFrame, folder: str, width: int = WIDTH, height: int = HEIGHT, one_shard: int = ONE_SHARD) -> DataFrame:
    """``leaves`` and ``saved`` summed over the subtree of every node.

    ``nodes``: ``conv_id`` and ``depth``, which name a node, the parent's ``pconv`` and ``pdepth`` (null above the root; a
    parent is less deep), and the node's own ``leaves`` and ``saved``.
    """
    nodes = stored(nodes, f"{folder}/nodes")
    one = nodes.limit(one_shard + 1).count() <= one_shard
    local = stored(_in_shards(nodes, width, height, one), f"{folder}/local")
    total = ["conv_id", "depth", "leaves", "saved"]
    sums = [F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")]
    pieces = local.where("out")
    below = pieces.where("pconv IS NOT NULL")
    if one or not below.head(1):
        return local.select(*total)
    port = [F.col("pconv").alias("conv_id"), F.col("pdepth").alias("depth")]
    ports = local.join(below.select(*port).distinct(), ["conv_id", "depth"]).select("conv_id", "depth", "rconv", "rdepth")
    ports = stored(ports, f"{folder}/ports")
    waits = ports.select(F.col("rconv").alias("conv_id"), F.col("rdepth").alias("depth")).distinct().withColumn("waits", F.lit(True))
    pieces = stored(pieces.join(waits, ["conv_id", "depth"], "left").drop("rconv", "rdepth"), f"{folder}/pieces")
    ready = pieces.where("waits IS NULL AND pconv IS NOT NULL").select(*port, "leaves", "saved")
    ready = stored(ready.groupBy("conv_id", "depth").agg(*sums), f"{folder}/ready")
    # The smaller trie: pieces that wait for others, with what is ready for them.
    own = pieces.where("waits")
    given = ready.join(ports, ["conv_id", "depth"]).select(F.col("rconv").alias("conv_id"), F.col("rdepth").alias("depth"), "leaves", "saved")
    values = own.select(*total).union(given.select(*total)).groupBy("conv_id", "depth").agg(*sums)
    above = ports.select(F.col("conv_id").alias("pconv"), F.col("depth").alias("pdepth"), "rconv", "rdepth")
    links = own.select("conv_id", "depth", "pconv", "pdepth").join(above, ["pconv", "pdepth"], "left")
    links = links.select("conv_id", "depth", F.col("rconv").alias("pconv"), F.col("rdepth").alias("pdepth"))
    upper = subtree_totals(links.join(values, ["conv_id", "depth"]), f"{folder}/upper", width * WIDER, height * WIDER, one_shard)
    late = upper.join(own.select("conv_id", "depth", "pconv", "pdepth"), ["conv_id", "depth"]).where("pconv IS NOT NULL")
    extra = ready.union(late.select(*port, "leaves", "saved")).groupBy("conv_id", "depth")
    extra = extra.agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
    filled = nodes.join(extra, ["conv_id", "depth"], "left")
    filled = filled.select(
        *("conv_id", "depth", "pconv", "pdepth"),
        *((F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c) for c in ("leaves", "saved")),
    )
    return _in_shards(filled, width, height, False).select(*total)


SEGMENTS = "depth long, hi long, lo long, first long, ids string"


def _ends(members: DataFrame) -> DataFrame:
    """The SHA-256 of the ids that end at a node, for nodes that have any."""

    def segments(batches: Iterator) -> Iterator:
        names, kinds = _schema(SEGMENTS)
        node, ids, size, out = None, [], 0, []
        for batch in batches:
            for *at, conv in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if at != node or size > SEGMENT:
                    if ids:
                        out.append((*node, ids[0], ",".join(map(str, ids))))
                    node, ids, size = at, [], 0
                    if len(out) >= 1024:
                        yield _batch(out, names, kinds)
                        out = []
                ids.append(conv)
                size += 20
        if ids:
            out.append((*node, ids[0], ",".join(map(str, ids))))
        if out:
            yield _batch(out, names, kinds)

    schema = "depth long, hi long, lo long, ends_sha256 string"

    def hashes(batches: Iterator) -> Iterator:
        names, kinds = _schema(schema)
        node, state, out = None, None, []
        for batch in batches:
            for *at, text in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if at != node:
                    if node is not None:
                        out.append((*node, state.hexdigest()))
                    node, state = at, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(text.encode())
            if len(out) >= 4096:
                yield _batch(out, names, kinds)
                out = []
        if node is not None:
            out.append((*node, state.hexdigest()))
        if out:
            yield _batch(out, names, kinds)

    key = ["depth", "hi", "lo"]
    ends = members.where("ends").select(*key, "conv_id")
    parts = ends.repartitionByRange(*key, "conv_id").sortWithinPartitions(*key, "conv_id").mapInArrow(segments, SEGMENTS)
    return parts.repartition(*key).sortWithinPartitions(*key, "first").select(*key, "ids").mapInArrow(hashes, schema)


def trie(rows: DataFrame, folder: str, width: int = WIDTH, height: int = HEIGHT, one_shard: int = ONE_SHARD) -> DataFrame:
    """One row for each node, from the rows of ``conversation_turns`` or ``rebuilt_turns``."""
    members = _members(stored(_steps(rows), f"{folder}/steps"))
    nodes = stored(_nodes(members), f"{folder}/named")
    parents = nodes.join(_parents(nodes), ["conv_id", "depth"], "left")
    pconv = F.when(F.col("depth") > 0, F.coalesce("pconv", "conv_id"))
    parents = parents.withColumn("pconv", pconv).withColumn("pdepth", F.when(F.col("depth") > 0, F.col("depth") - 1))
    parents = stored(parents, f"{folder}/parents")
    children = parents.where("depth > 0").groupBy(F.col("pconv").alias("conv_id"), F.col("pdepth").alias("depth"))
    known = parents.join(children.agg(F.count("*").alias("n_children")), ["conv_id", "depth"], "left").fillna(0, ["n_children"])
    known = stored(known, f"{folder}/known")
    own = [F.expr("if(n_children = 0, 1L, 0L)").alias("leaves"), ((F.col("n_convs") - 1) * F.col("points")).alias("saved")]
    totals = subtree_totals(known.select("conv_id", "depth", "pconv", "pdepth", *own), f"{folder}/totals", width, height, one_shard)
    found = known.join(totals, ["conv_id", "depth"]).join(_ends(members), ["depth", "hi", "lo"], "left")
    return found.select(
        "conv_id",
        "depth",
        F.col("pconv").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )


def prefix_trie(conversations: DataFrame, rebuild: bool = False) -> DataFrame:
    """The trie of ``conversations``; with ``rebuild`` of those that begin like the first one of their block."""
    folder = run_folder(conversations.sparkSession, "prefix-trie")
    rows = rebuilt_turns(conversations, folder) if rebuild else conversation_turns(conversations, folder)
    return trie(rows, folder)
