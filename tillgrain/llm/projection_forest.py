"""Approximate nearest neighbours by a forest of random-projection trees.

Each tree halves a bounded sample of the vectors again and again at the median of a
random direction, until a node holds at most ``LEAF_SAMPLE`` of them. Every row is then
put into its leaf of every tree. A query walks all trees through one priority queue: the
next node is the one whose worst margin on the way down is best, over all trees; the
leaves that it takes are the candidates, which are reranked by exact distance.

Equal vectors are one class, searched once; a class keeps the k + 1 smallest ids, which is
all that ties to smaller ids can need, so thousands of copies neither fill a leaf nor a
result.

Only the trees are broadcast; the sample bounds their size. Rows and queries meet by
(tree, leaf, block) key, where a leaf beyond ``BLOCK_ROWS`` rows on average is dealt into
blocks and the queries go to each. Distances are taken there, and only the best k per
query and block go on.

Defined cases: a vector that is null, empty, zero or holds a null or non-finite component
takes no part, nor does a row without an id. Vectors of another length than the most
frequent one (the longer on a tie) take no part either. Rows that repeat an id and vector count once. Columns besides the two
named ones are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillgrain.llm.support import grouped, importable, map_batches, materialise

TREES = 24
SAMPLE_ROWS = 20_000
LEAF_SAMPLE = 40
# Leaves that one query takes from all trees together.
LEAVES = 300
SEED = 7
# Rows of a leaf that meet its queries at once, on average.
BLOCK_ROWS = 4096


class Tree:
    """Directions and thresholds of inner nodes; children below zero are leaves."""

    def __init__(self, sample: np.ndarray, rng: np.random.Generator) -> None:
        self.directions: list[np.ndarray] = []
        self.thresholds: list[float] = []
        self.children: list[list[int]] = []
        self.leaves = 0
        self._root = self._grow(sample, rng)
        self.direction = np.array(self.directions) if self.directions else None

    def _leaf(self) -> int:
        self.leaves += 1
        return -self.leaves

    def _grow(self, sample: np.ndarray, rng: np.random.Generator) -> int:
        if sample.shape[0] <= LEAF_SAMPLE:
            return self._leaf()
        a, b = sample[rng.choice(sample.shape[0], 2, replace=False)]
        direction = a - b
        length = np.linalg.norm(direction)
        if length == 0:
            direction = rng.standard_normal(sample.shape[1])
            length = np.linalg.norm(direction)
        direction /= length
        side = sample @ direction
        middle = float(np.median(side))
        left = side < middle
        if not left.any() or left.all():
            return self._leaf()
        node = len(self.thresholds)
        self.directions.append(direction)
        self.thresholds.append(middle)
        self.children.append([0, 0])
        self.children[node] = [self._grow(sample[left], rng), self._grow(sample[~left], rng)]
        return node

    @property
    def root(self) -> int:
        return self._root

    def margins(self, vectors: np.ndarray) -> np.ndarray:
        """Signed distance of each vector from each node's plane."""
        if self.direction is None:
            return np.zeros((vectors.shape[0], 0))
        return vectors @ self.direction.T - np.array(self.thresholds)

    def leaf_of(self, margins: np.ndarray) -> int:
        node = self._root
        while node >= 0:
            node = self.children[node][int(margins[node] >= 0)]
        return -node - 1


def nearest_leaves(trees: list[Tree], margins: list[np.ndarray], wanted: int) -> list[tuple[int, int]]:
    """(tree, leaf) in the order of one queue shared by all trees."""
    queue = [(0.0, t, tree.root) for t, tree in enumerate(trees)]
    found: list[tuple[int, int]] = []
    while queue and len(found) < wanted:
        worst, t, node = heapq.heappop(queue)
        while node >= 0:
            m = float(margins[t][node])
            near = int(m >= 0)
            heapq.heappush(queue, (max(worst, abs(m)), t, trees[t].children[node][1 - near]))
            node = trees[t].children[node][near]
        found.append((t, -node - 1))
    return found


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): the vectors that take part, as doubles, once per id."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = (
        vectors.where("vec_id is not null and embedding is not null")
        .select("vec_id", v.alias("v"))
        .where(~bad & F.exists("v", lambda x: x != 0))
        .withColumn("v", F.transform("v", lambda x: F.when(x == 0, 0.0).otherwise(x)))
        .distinct()
    )
    return rows


def classes(rows: DataFrame, keep: int) -> DataFrame:
    """(rep, v, ids): distinct vectors with their ``keep`` smallest ids."""
    # The row number prunes copies before the shuffle: at most ``keep`` per task and vector.
    order = Window.partitionBy("v").orderBy("vec_id")
    few = rows.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= keep)
    return few.groupBy("v").agg(
        F.min("vec_id").alias("rep"), F.sort_array(F.collect_list("vec_id")).alias("ids")
    )


def forest(spark: SparkSession, known: DataFrame, width: int) -> list[Tree]:
    """Trees over at most SAMPLE_ROWS class vectors, those of the smallest hash of the id."""
    sample = known.orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE_ROWS).select("v").toArrow()
    flat = sample.column("v").combine_chunks()
    data = np.asarray(flat.flatten()).reshape(-1, width) if len(flat) else np.zeros((0, width))
    rng = np.random.default_rng(SEED)
    return [Tree(data, rng) for _ in range(TREES)]


def _matrix(batch: pa.RecordBatch, place: int, width: int) -> np.ndarray:
    return np.asarray(batch.column(place).flatten()).reshape(-1, width)


_MEETING = "tree int, leaf int, block bigint, asks boolean, id bigint, v array<double>"


def placed(known: DataFrame, shared, width: int, blocks: int) -> DataFrame:
    """Every class in its leaf of every tree."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            reps = batch.column(0).to_numpy()
            vectors = _matrix(batch, 1, width)
            for t, tree in enumerate(shared.value):
                leaves = [tree.leaf_of(m) for m in tree.margins(vectors)]
                yield {
                    "tree": np.full(reps.size, t, np.int32),
                    "leaf": np.array(leaves, dtype=np.int32),
                    "block": (reps.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % blocks,
                    "asks": np.zeros(reps.size, dtype=bool),
                    "id": reps,
                    "v": batch.column(1),
                }

    return map_batches(known.select("rep", "v"), step, _MEETING)


def probes(queries: DataFrame, shared, width: int, blocks: int, leaves: int) -> DataFrame:
    """The leaves that each query class takes, in every block of the leaf."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            vectors = _matrix(batch, 1, width)
            margins = [tree.margins(vectors) for tree in shared.value]
            for i in range(batch.num_rows):
                taken = nearest_leaves(shared.value, [m[i] for m in margins], leaves)
                n = len(taken) * blocks
                tree, leaf = np.repeat(np.array(taken, dtype=np.int32), blocks, axis=0).T
                yield {
                    "tree": tree,
                    "leaf": leaf,
                    "block": np.tile(np.arange(blocks), len(taken)),
                    "asks": np.ones(n, dtype=bool),
                    "id": batch.column(0).take(pa.array(np.full(n, i))),
                    "v": batch.column(1).take(pa.array(np.full(n, i))),
                }

    return map_batches(queries.select("q", "v"), step, _MEETING)


def _scored(meeting: DataFrame, width: int, keep: int) -> DataFrame:
    """(q, rep, score): per query and block the ``keep`` nearest rows."""

    def best(q: np.ndarray, rows: np.ndarray, reps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        score = np.sqrt(((rows - q) ** 2).sum(axis=1))
        if score.size > keep:
            limit = np.partition(score, keep - 1)[keep - 1]
            near = np.flatnonzero(score <= limit)
            near = near[np.lexsort((reps[near], score[near]))][:keep]
            return reps[near], score[near]
        return reps, score

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for run in grouped(batches, ["tree", "leaf", "block"]):
            asks = np.concatenate([b.column(3).to_numpy(zero_copy_only=False) for b in run])
            if asks.all() or not asks.any():
                continue
            ids = np.concatenate([b.column(4).to_numpy() for b in run])
            vectors = np.concatenate([_matrix(b, 5, width) for b in run])
            rows, reps = vectors[~asks], ids[~asks]
            found = [(q, *best(v, rows, reps)) for q, v in zip(ids[asks], vectors[asks], strict=True)]
            yield {
                "q": np.repeat(ids[asks], [f[1].size for f in found]),
                "rep": np.concatenate([f[1] for f in found]),
                "score": np.concatenate([f[2] for f in found]),
            }

    keys = ["tree", "leaf", "block"]
    return map_batches(
        meeting.repartition(*keys).sortWithinPartitions(*keys),
        step,
        "q bigint, rep bigint, score double",
    )


def search(spark: SparkSession, vectors: DataFrame, every: int, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row whose id is divisible
    by ``every``, among all other rows, ties to the smaller id."""
    importable(spark)
    rows = usable(vectors)
    widths = rows.groupBy(F.size("v").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    best = widths.orderBy(F.desc("n"), F.desc("w")).first()
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    if best is None:
        return spark.createDataFrame([], schema)
    width = best["w"]
    rows = rows.where(F.size("v") == width)
    known = materialise(spark, classes(rows, k + 1), "vectors")
    shared = spark.sparkContext.broadcast(forest(spark, known, width))
    blocks = known.count() // (BLOCK_ROWS * max(1, min(t.leaves for t in shared.value))) + 1
    # A class is a query if any of its members is; members are told apart at the end.
    asking = materialise(
        spark,
        rows.where(F.col("vec_id") % every == 0).join(known.select("v", "rep"), "v").select("vec_id", "rep"),
        "asking",
    )
    queries = known.join(asking.select("rep").distinct(), "rep").select(F.col("rep").alias("q"), "v")
    meeting = placed(known, shared, width, blocks).union(
        probes(queries, shared, width, blocks, LEAVES)
    )
    # A class met in several trees has the same score in each.
    best_first = Window.partitionBy("q").orderBy("score", "rep")
    near = (
        _scored(meeting, width, k + 1)
        .groupBy("q", "rep")
        .agg(F.min("score").alias("score"))
        .withColumn("_n", F.row_number().over(best_first))
        .where(F.col("_n") <= k + 1)
        .join(known.select("rep", "ids"), "rep")
        .select("q", "score", "ids")
    )
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        asking.select(F.col("vec_id").alias("query_id"), F.col("rep").alias("q"))
        .join(near, "q")
        .select("query_id", "score", F.explode("ids").alias("vec_id"))
        .where("vec_id <> query_id")
        .withColumn("rank", F.row_number().over(order).cast("int"))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
