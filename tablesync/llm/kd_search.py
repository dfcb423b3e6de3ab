"""Exact top-k by inner product with a KD-tree for each shard.

Vectors of the commonest length are dealt to cells by the top splits of a KD-tree over a sample, and a cell to as many shards as
its rows need; other lengths are dealt by a hash of the id. The sample (``SAMPLE`` rows with the smallest hashes of
their ids) only says where the cells are: every row is in a shard and every answer is exact. Each shard splits its rows at the median of
the widest side, down to small leaves, and every node keeps the tight box around its
rows. The largest inner product that a query can have in a box is the sum, over the
components, of the larger of the products with the box's two sides; nodes are
visited from the best bound down, and the visit ends when a bound is below the query's
k-th score. A query first searches its home shard; the k-th score found there goes
along, and the query is sent to just those shards whose whole box may hold such a score.

Blocks of queries meet blocks of boxes, not rows, to find these shards, so a task's share is bounded whatever the
number of queries and shards. Spark deals the pairs of shard and block.

Defined cases: vectors that are null, or hold nulls or non-finite components take
no part, nor do rows without an id; vectors are compared with those of the same length only, empty ones with
a score of 0; of rows that repeat
an id the smallest vector counts; ties go to the smaller id; a component or a score that 64 bits can't hold is an error;
an empty table gives an empty result; other columns are not read, whatever their names. A vector is a row of a task's
matrix: a task holds ``MOST_SHARD`` of them.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablesync.llm.graph import stored
from tablesync.session import run_folder

# Rows of a shard: as many as give every core several shards, within these bounds.
LEAST_SHARD, MOST_SHARD, SHARDS_PER_CORE = 256, 1 << 15, 4
QUERY_BLOCK = BOX_BLOCK = 1 << 12
# Rows of the sample for the top splits, and the cells that they make at most.
SAMPLE, CELLS = 1 << 12, 1 << 8
LEAF = 64
# Bounds that a task holds at once.
HELD_BOUNDS = 1 << 20
FOUND = "query_id long, vec_id long, score long"
FOUND_AND_BOX = f"{FOUND}, dim int, shard int, low array<long>, high array<long>"


class Tree:
    """Median splits with tight boxes; leaves hold up to ``leaf`` rows."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF):
        self.low, self.high, self.child, self.rows = [], [], [], []
        self.ids, self.vectors = ids, vectors
        self._grow(np.arange(len(ids)), leaf)
        self.low, self.high = np.array(self.low), np.array(self.high)

    def _grow(self, rows: np.ndarray, leaf: int) -> int:
        node, part = len(self.low), self.vectors[rows]
        low, high = part.min(axis=0), part.max(axis=0)
        self.low.append(low)
        self.high.append(high)
        self.child.append(None)
        self.rows.append(rows)
        if len(rows) > leaf and (low != high).any():
            axis, middle = int(np.argmax(high - low)), len(rows) // 2
            order = np.argsort(part[:, axis], kind="stable")
            self.rows[node] = None
            self.child[node] = (self._grow(rows[order[:middle]], leaf), self._grow(rows[order[middle:]], leaf))
        return node

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """For each query and node, the largest score any vector in the node's box can have."""
        zero = queries.dtype.type(0) if queries.dtype != object else 0
        return np.maximum(queries, zero) @ self.high.T + np.minimum(queries, zero) @ self.low.T

    def search(self, query: np.ndarray, own: int, bound: np.ndarray, k: int, least: int | None) -> list[tuple[int, int]]:
        """The k best (score, minus id) but ``own``, those under ``least`` left out."""
        best: list[tuple[int, int]] = []
        todo = [(-bound[0], 0)]
        while todo:
            worst, node = heapq.heappop(todo)
            limit = best[0][0] if len(best) == k else least
            if limit is not None and -worst < limit:
                break
            if self.child[node] is not None:
                for c in self.child[node]:
                    heapq.heappush(todo, (-bound[c], c))
                continue
            rows = self.rows[node]
            scores = self.vectors[rows] @ query
            if limit is not None:
                fits = scores >= limit
                rows, scores = rows[fits], scores[fits]
            for score, vec in zip(scores.tolist(), self.ids[rows].tolist(), strict=True):
                if vec == own:
                    continue
                entry = (int(score), -vec)
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
        return best


class TopSplits:
    """A full binary tree of median splits over a sample; a cell is one of its ``1 << depth`` leaves."""

    def __init__(self, sample: np.ndarray, cells: int):
        self.depth = max(0, min(cells, len(sample)).bit_length() - 1)
        self.axis, self.at = [0] * ((1 << self.depth) - 1), [0] * ((1 << self.depth) - 1)
        self._split(sample, 0)

    def _split(self, part: np.ndarray, node: int) -> None:
        if node >= len(self.axis):
            return
        if len(part):
            # Sides as Python's integers, which do not overflow.
            sides = [int(h) - int(x) for h, x in zip(part.max(axis=0), part.min(axis=0), strict=True)]
            self.axis[node] = int(np.argmax(sides))
            side = part[:, self.axis[node]]
            # Rows at or above the middle one go right, unless all would; then those above it do.
            self.at[node] = int(np.sort(side)[len(side) // 2])
            if self.at[node] == side.min():
                self.at[node] = min(self.at[node] + 1, 2**63 - 1)
            low = side < self.at[node]
            self._split(part[low], 2 * node + 1)
            self._split(part[~low], 2 * node + 2)
        else:
            self._split(part, 2 * node + 1)
            self._split(part, 2 * node + 2)

    def cell(self, vector: Column) -> Column:
        if not self.depth:
            return F.lit(0)
        axis, at = F.array(*map(F.lit, self.axis)), F.array(*[F.lit(x).cast("long") for x in self.at])

        def down(node: Column, _: Column) -> Column:
            right = F.get(vector, F.get(axis, node)) >= F.get(at, node)
            return node * 2 + F.when(right, 2).otherwise(1)

        leaf = F.aggregate(F.sequence(F.lit(1), F.lit(self.depth)), F.lit(0), down)
        return leaf - F.lit((1 << self.depth) - 1)


def _kind(*parts: np.ndarray) -> type:
    """Floats where all sums are exact in them, else Python's integers."""
    most = max(max(abs(int(p.min())), abs(int(p.max()))) for p in parts)
    return np.float64 if most * most * parts[0].shape[1] < 2**53 else object


def _found(tree: Tree, ids: np.ndarray, queries: np.ndarray, least: list, k: int) -> dict[str, list]:
    bounds = tree.bounds(queries)
    out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
    for own, query, bound, low in zip(ids.tolist(), queries, bounds.tolist(), least, strict=True):
        for score, vec in tree.search(query, own, bound, k, low):
            out["query_id"].append(own)
            out["vec_id"].append(-vec)
            out["score"].append(score)
    return out


def dealt(rows: DataFrame, count: int, per_shard: int, cells: int = CELLS, sample: int = SAMPLE) -> tuple[DataFrame, int]:
    """``vec_id``, ``v``, ``dim`` and ``shard`` of every row, near ones together, and the number of shards."""
    rows = rows.withColumn("dim", F.size("v"))
    # Cells of a shard's rows or fewer, while that takes no more than ``cells``.
    cells = min(cells, 1 << (max(1, -(-count // per_shard)) - 1).bit_length())
    some = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()
    lengths = [r["dim"] for r in some]
    dim = max(set(lengths), key=lambda n: (lengths.count(n), n)) if lengths else 1
    splits = TopSplits(np.array([r["v"] for r in some if r["dim"] == dim], np.int64).reshape(-1, dim), cells)
    rows = rows.withColumn("cell", F.when(F.col("dim") == dim, splits.cell(F.col("v"))).otherwise(-1))
    # A row for each cell at most.
    held = {r["cell"]: r["count"] for r in rows.groupBy("cell").count().collect()}
    parts = [-(-held.get(c, 0) // per_shard) for c in range(1 << splits.depth)]
    first = [sum(parts[:c]) for c in range(len(parts))]
    shards = max(1, sum(parts), -(-held.get(-1, 0) // per_shard))

    def of_cell(values: list[int]) -> Column:
        return F.get(F.array(*map(F.lit, values)), F.col("cell"))

    place = F.xxhash64("vec_id")
    near = of_cell(first) + F.pmod(place, F.greatest(of_cell(parts), F.lit(1)))
    shard = F.when(F.col("cell") >= 0, near).otherwise(F.pmod(place, F.lit(shards))).cast("int")
    return rows.select("vec_id", "v", "dim", shard.alias("shard")), shards


def shards_in_reach(asked: DataFrame, boxes: DataFrame, shards: int, blocks: int) -> DataFrame:
    """``asked`` with a row for each other shard whose box allows a score of ``least`` or more, as ``away``.

    ``asked``: ``vec_id``, ``v``, ``dim``, ``shard``, ``block``, ``least``; ``boxes``: ``dim``, ``shard``, ``low``, ``high``.
    """
    import pandas as pd

    asked = asked.withColumn("boxes", F.explode(F.sequence(F.lit(0), F.lit((shards - 1) // BOX_BLOCK))))
    boxes = boxes.withColumn("boxes", (F.col("shard") / BOX_BLOCK).cast("int"))
    boxes = boxes.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    boxes = boxes.select(*[F.col(c).alias(f"b_{c}") for c in ("dim", "block", "boxes", "shard", "low", "high")])

    def reach(queries: pd.DataFrame, around: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(around):
            return queries.iloc[:0].assign(away=None)
        data, low, high = (np.stack(c.to_numpy()) for c in (queries["v"], around["b_low"], around["b_high"]))
        kind = _kind(data, low, high)
        data, low, high = data.astype(kind), low.astype(kind), high.astype(kind)
        places, found = around["b_shard"].to_numpy(np.int32), []
        least = [int(x) if abs(x) < 2**53 else None for x in queries["least"].astype(float)]
        step = max(1, HELD_BOUNDS // len(places))
        for first in range(0, len(data), step):
            part = data[first : first + step]
            bounds = np.maximum(part, 0) @ high.T + np.minimum(part, 0) @ low.T
            for bound, limit in zip(bounds, least[first : first + step], strict=True):
                found.append(places if limit is None else places[(bound >= limit).astype(bool)])
        return queries.assign(away=found)

    kinds = "vec_id long, v array<long>, dim int, shard int, block int, least long, boxes int"
    asked = asked.select(*[c.split()[0] for c in kinds.split(", ")])
    pairs = asked.groupBy("dim", "block", "boxes").cogroup(boxes.groupBy("b_dim", "b_block", "b_boxes"))
    pairs = pairs.applyInPandas(reach, f"{kinds}, away array<int>")
    pairs = pairs.withColumn("away", F.explode("away")).where(F.col("away") != F.col("shard"))
    return pairs.select("vec_id", "v", "dim", "block", "least", "away")


def exact_top_k(
    vectors: DataFrame, k: int = 5, every: int = 50, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the k best rows for each query; ids divisible by ``every`` ask."""
    import pandas as pd

    spark = vectors.sparkSession
    folder = run_folder(spark, "kd-search")
    rows = vectors.select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v")
    )
    whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & whole)

    def held(x: Column) -> Column:
        # Beyond 64 bits a floor would stop at the largest number they hold.
        too_large = F.raise_error(F.lit("a component of a vector is beyond 64 bits")).cast("long")
        return F.when(F.abs(x * scale) < 2.0**63, F.floor(x * scale)).otherwise(too_large)

    rows = rows.select("vec_id", F.transform("v", held).alias("v"))
    rows = stored(rows.groupBy("vec_id").agg(F.min("v").alias("v")), f"{folder}/vectors")

    empty, rows = rows.where(F.size("v") == 0), rows.where(F.size("v") > 0)
    count = rows.count()
    per_shard = min(MOST_SHARD, max(LEAST_SHARD, count // (SHARDS_PER_CORE * spark.sparkContext.defaultParallelism)))
    blocks = max(1, -(-(count // every) // QUERY_BLOCK))
    rows, shards = dealt(rows, count, per_shard)
    rows = rows.withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "vec_id"), F.lit(blocks)).cast("int"))

    def home(part: pd.DataFrame) -> pd.DataFrame:
        """The scores of the shard's own queries, and in one more row its box."""
        ids, data = part["vec_id"].to_numpy(np.int64), np.stack(part["v"].to_numpy())
        low, high = data.min(axis=0), data.max(axis=0)
        data = data.astype(_kind(data))
        asks = ids % every == 0
        found = _found(Tree(ids, data), ids[asks], data[asks], [None] * int(asks.sum()), k)
        scores, box = len(found["query_id"]), (int(part["dim"].iloc[0]), int(part["shard"].iloc[0]), low, high)
        columns = {c: [*values, None] for c, values in found.items()}
        columns |= {c: [*[None] * scores, v] for c, v in zip(("dim", "shard", "low", "high"), box, strict=True)}
        return pd.DataFrame(columns, dtype=object)

    at_home = rows.groupBy("dim", "shard").applyInPandas(home, FOUND_AND_BOX)
    at_home = stored(at_home, f"{folder}/home")
    boxes = at_home.where("query_id IS NULL").select("dim", "shard", "low", "high")
    at_home = at_home.where("query_id IS NOT NULL").select("query_id", "vec_id", "score")

    limits = at_home.groupBy("query_id").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n"))
    limits = limits.select("query_id", F.when(F.col("n") == k, F.col("least")).alias("least"))
    asked = rows.where(F.col("vec_id") % every == 0)
    asked = asked.join(limits, F.col("vec_id") == F.col("query_id"), "left")
    asked = stored(shards_in_reach(asked, boxes, shards, blocks), f"{folder}/asked")
    # A shard's rows go to the blocks whose queries reach it.
    met = asked.select("dim", F.col("away").alias("shard"), "block").distinct()
    parts = rows.select("vec_id", "v", "dim", "shard").join(met, ["dim", "shard"])

    def away(part: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(part) or not len(queries):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        data, asks = np.stack(part["v"].to_numpy()), np.stack(queries["q_v"].to_numpy())
        kind = _kind(data, asks)
        # Nulls make this column one of floats; a limit that they can't hold is left out.
        least = [int(x) if abs(x) < 2**53 else None for x in queries["q_least"].astype(float)]
        tree = Tree(part["vec_id"].to_numpy(np.int64), data.astype(kind))
        return pd.DataFrame(_found(tree, queries["q_vec_id"].to_numpy(np.int64), asks.astype(kind), least, k))

    # Names of their own: both sides come from one table.
    asked = asked.select(F.col("dim").alias("d"), F.col("away").alias("s"), F.col("block").alias("b"), *[
        F.col(c).alias(f"q_{c}") for c in ("vec_id", "v", "least")
    ])
    far = parts.groupBy("dim", "shard", "block").cogroup(asked.groupBy("d", "s", "b")).applyInPandas(away, FOUND)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    # Empty vectors all score 0, so the first k + 1 ids answer every query among them.
    first = empty.select("vec_id").orderBy("vec_id").limit(k + 1).agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    others = F.slice(F.filter(F.lit([r for r in first.first()["ids"]]).cast("array<long>"), lambda x: x != F.col("vec_id")), 1, k)
    blank = empty.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), F.explode(others).alias("vec_id"))
    blank = blank.withColumn("score", F.lit(0).cast("long"))
    found = at_home.unionByName(far).unionByName(blank).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")
