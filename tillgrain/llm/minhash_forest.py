"""Near-duplicate documents by an LSH forest over MinHash signatures.

Signatures are read in several orders (trees). A tree sorts the documents by its own
stretch of the signature; documents whose longest common prefix has four values or more
form a region and are candidates. The depth is the same for a region of any size, so
that what is found does not depend on how many documents stand around a pair.

Steps, each a Spark job whose rows follow the input:

1. One pass over the texts: shingle set size, a 128-bit hash of the set, signature.
2. Equal sets are one class, represented by its smallest id.
3. Regions of the forest; inside a region the signatures are compared and the
   candidates are tied together by as many edges as there are documents (not pairs).
4. Components of these edges are blocks. Full sets are brought together once per
   block; every pair inside is confirmed by exact counts, and again one edge per
   document leaves the task. A block beyond ``BLOCK_ROWS`` or ``BLOCK_SHINGLES``
   is split along the forest's regions.
5. Components of the confirmed links.

A class, region or block of any size is handled: keys are pre-aggregated, and a region
beyond its bound is dealt into slices, every two of which are compared as a task of
their own; the rows dealt grow with the square of such a region. A pair of Jaccard
similarity J misses all sixteen trees with the probability (1 - J ** 4) ** 16: 7e-6 at
0.85, 2.2e-4 at 0.80.

Defined cases: a null or wordless text has an empty set and is linked with nothing.
A row without an id is linked with nothing, has no component and is kept. Rows that
repeat an id get the component of their own text. Further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillgrain.llm.components import components
from tillgrain.llm.support import grouped, map_batches, materialise, texts_of
from tillgrain.llm.words import mix, shingles

TREES = 16
DEPTH = 8
# Values that make a region: four of 16 bits fill one 64-bit key.
PREFIX = 4
HASHES = TREES * DEPTH
# Bounds of what one task compares at once; beyond them, slices meet pair by pair.
REGION_ROWS = 4096
BLOCK_ROWS = 4096
BLOCK_SHINGLES = 4_000_000
SPLIT_ROWS = 1024
_COLUMN_CHUNK = 2048

_MULTIPLIERS = mix(np.arange(1, HASHES + 1, dtype=np.uint64)) | np.uint64(1)


def signature(shingle_set: np.ndarray) -> np.ndarray:
    """One 16-bit value per hash function: of the smallest hash over the set."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for start in range(0, shingle_set.size, 256):
        part = shingle_set[start : start + 256, None] * _MULTIPLIERS
        np.minimum(least, part.min(axis=0), out=least)
    return (mix(least) >> np.uint64(48)).astype(np.uint16)


def fingerprints(docs: DataFrame, size: int) -> DataFrame:
    """Per row: id, set size, 128-bit set hash, signature (null for an empty set)."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            n, first, second, signatures = [], [], [], []
            for text in texts_of(batch):
                found = shingles(text, size)
                n.append(found.size)
                first.append(mix(found, 1).sum(dtype=np.uint64).astype(np.int64))
                second.append(mix(found, 2).sum(dtype=np.uint64).astype(np.int64))
                signatures.append(signature(found).tobytes() if found.size else None)
            yield {
                "doc_id": batch.column(0),
                "n_shingles": pa.array(n, pa.int64()),
                "k1": pa.array(first, pa.int64()),
                "k2": pa.array(second, pa.int64()),
                "signature": pa.array(signatures, pa.binary()),
            }

    return map_batches(
        docs.select("doc_id", "text"),
        step,
        "doc_id bigint, n_shingles bigint, k1 bigint, k2 bigint, signature binary",
    )


def _tree_rows(classes: DataFrame) -> DataFrame:
    """(rep, tree, p4): the first four values of each representative in each tree."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        trees = np.arange(TREES, dtype=np.int32)
        for batch in batches:
            reps = batch.column(0).to_numpy(zero_copy_only=False)
            packed = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.int64)
            first = packed.reshape(-1, TREES, DEPTH // PREFIX)[:, :, 0]
            yield {
                "rep": np.repeat(reps, TREES),
                "tree": np.tile(trees, reps.size),
                "p4": first.ravel(),
            }

    return map_batches(
        classes.select("rep", "signature"), step, "rep bigint, tree int, p4 bigint"
    )


def _regions(rows: DataFrame, keys: list[str], limit: int) -> DataFrame:
    """Rows of regions with company, with ``r1``, ``r2``: the region, or a part of it.

    Sizes are counted with partial aggregation. A region over the limit is dealt into
    slices of half of it, and every two slices meet in a part of their own.
    """
    wide = rows.groupBy(*keys, "p4").agg(F.count(F.lit(1)).alias("c4")).where("c4 > 1")
    placed = rows.join(wide, [*keys, "p4"])
    placed = placed.select(*rows.columns, *_slice_pairs(F.col("c4"), limit))
    placed = placed.select("*", F.explode("others").alias("other"))
    region = [*keys, "p4", F.least("own", "other"), F.greatest("own", "other")]
    return placed.withColumn("r1", F.xxhash64(*region)).withColumn(
        "r2", F.xxhash64(F.lit("second"), *region)
    )


def _slice_pairs(count: Column, limit: int) -> tuple[Column, Column]:
    """``own``, the row's slice of a region of ``count`` rows, and ``others``, those it meets.

    One slice meets itself; of several, each meets every other, so that any two rows
    stand together in at least one pair of slices.
    """
    half = max(1, limit // 2)
    slices = F.when(count > limit, F.ceil(count / half)).otherwise(F.lit(1)).cast("bigint")
    own = F.pmod(F.xxhash64("rep", "tree"), slices)
    every = F.sequence(F.lit(0).cast("bigint"), slices - 1)
    others = F.when(slices > 1, F.array_remove(every, own)).otherwise(every)
    return own.alias("own"), others.alias("others")


def _stars(linked: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from every member to the smallest id of its component (dense links)."""
    n = ids.size
    label = np.full(n, -1)
    for seed in np.argsort(ids, kind="stable"):
        if label[seed] >= 0:
            continue
        label[seed] = seed
        frontier = np.array([seed])
        while frontier.size:
            reached = np.flatnonzero(linked[frontier].any(axis=0) & (label < 0))
            label[reached] = seed
            frontier = reached
    tied = np.flatnonzero(label != np.arange(n))
    return ids[tied], ids[label[tied]]


def _candidate_edges(regions: DataFrame, least_matches: int) -> DataFrame:
    """Tie together what agrees in ``least_matches`` signature values, region by region."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        out_a: list[np.ndarray] = []
        out_b: list[np.ndarray] = []
        for run in grouped(batches, ["r1", "r2"]):
            ids = np.concatenate([b.column(2).to_numpy() for b in run])
            if ids.size < 2:
                continue
            raw = b"".join(v for b in run for v in b.column(3).to_pylist())
            signatures = np.frombuffer(raw, dtype=np.uint16).reshape(-1, HASHES)
            linked = np.zeros((ids.size, ids.size), dtype=bool)
            for i in range(ids.size - 1):
                same = (signatures[i + 1 :] == signatures[i]).sum(axis=1) >= least_matches
                linked[i, i + 1 :] = same
            linked |= linked.T
            a, b = _stars(linked, ids)
            out_a.append(a)
            out_b.append(b)
            if len(out_a) >= 512:
                yield {"a": np.concatenate(out_a), "b": np.concatenate(out_b)}
                out_a, out_b = [], []
        if out_a:
            yield {"a": np.concatenate(out_a), "b": np.concatenate(out_b)}

    dealt = regions.select("r1", "r2", "rep", "signature").repartition("r1", "r2")
    return map_batches(dealt.sortWithinPartitions("r1", "r2"), step, "a bigint, b bigint")


def _sets_of(docs: DataFrame, size: int) -> DataFrame:
    """(rep, block keys, set) with the full sorted set as bytes, from the text."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            yield {
                "rep": batch.column(0),
                "shingles": pa.array(
                    [shingles(t, size).tobytes() for t in texts_of(batch)], pa.binary()
                ),
            }

    return map_batches(docs.select("rep", "text"), step, "rep bigint, shingles binary")


def _exact_links(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Which pairs have 100 * intersection >= percent * union, by exact counts.

    Only shingles of two or more sets can be shared; membership of those is a 0/1
    matrix, taken in chunks of columns, whose product with itself counts them.
    """
    n = len(sets)
    sizes = np.array([s.size for s in sets])
    every, owner = np.concatenate(sets), np.repeat(np.arange(n), sizes)
    values, column, count = np.unique(every, return_inverse=True, return_counts=True)
    shared = count > 1
    position = np.cumsum(shared) - 1
    keep = shared[column]
    column, owner = position[column[keep]], owner[keep]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    common = np.zeros((n, n), dtype=np.float32)
    for low in range(0, int(shared.sum()), _COLUMN_CHUNK):
        start, end = np.searchsorted(column, [low, low + _COLUMN_CHUNK])
        member = np.zeros((n, _COLUMN_CHUNK), dtype=np.float32)
        member[owner[start:end], column[start:end] - low] = 1
        present = np.flatnonzero(member.any(axis=1))
        part = member[present]
        common[np.ix_(present, present)] += part @ part.T
    linked = np.empty((n, n), dtype=bool)
    for low in range(0, n, 256):
        joint = common[low : low + 256].astype(np.int64)
        union = sizes[low : low + 256, None] + sizes[None, :] - joint
        linked[low : low + 256] = 100 * joint >= percent * union
    return linked


def _confirmed_edges(blocks: DataFrame, percent: int) -> DataFrame:
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for run in grouped(batches, ["r1", "r2"]):
            ids = np.concatenate([b.column(2).to_numpy() for b in run])
            if ids.size < 2:
                continue
            sets = [np.frombuffer(v, np.uint64) for b in run for v in b.column(3).to_pylist()]
            a, b = _stars(_exact_links(sets, percent), ids)
            if a.size:
                yield {"a": a, "b": b}

    dealt = blocks.select("r1", "r2", "rep", "shingles").repartition("r1", "r2")
    return map_batches(dealt.sortWithinPartitions("r1", "r2"), step, "a bigint, b bigint")


def least_matches(percent: int) -> int:
    """Signature values a linked pair shares, 4.5 standard deviations below the mean."""
    p = percent / 100
    return max(1, math.floor(HASHES * p - 4.5 * math.sqrt(HASHES * p * (1 - p))))


def near_duplicates(
    spark: SparkSession, docs: DataFrame, size: int = 5, percent: int = 80
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Documents are linked when the Jaccard similarity of their sets of ``size``-word
    shingles is at least ``percent`` / 100; a component is what links reach.
    """
    prints = materialise(spark, fingerprints(docs, size), "fingerprints")
    known = prints.where("n_shingles > 0 and doc_id is not null")
    key = ["n_shingles", "k1", "k2"]
    classes = materialise(
        spark,
        known.groupBy(*key).agg(
            F.min("doc_id").alias("rep"), F.first("signature").alias("signature")
        ),
        "classes",
    )
    trees = materialise(spark, _tree_rows(classes), "trees")
    regions = _regions(trees, ["tree"], REGION_ROWS).join(
        classes.select("rep", "signature"), "rep"
    )
    candidates = components(spark, _candidate_edges(regions, least_matches(percent)))

    weights = candidates.join(classes.select(F.col("rep").alias("id"), "n_shingles"), "id")
    giants = (
        weights.groupBy("root")
        .agg(F.count(F.lit(1)).alias("c"), F.sum("n_shingles").alias("s"))
        .where((F.col("c") > BLOCK_ROWS) | (F.col("s") > BLOCK_SHINGLES))
        .select("root")
    )
    members = candidates.select(F.col("id").alias("rep"), "root")
    whole = members.join(giants, "root", "left_anti").select(
        "rep", F.col("root").alias("r1"), F.lit(0).cast("bigint").alias("r2")
    )
    split = _regions(
        trees.join(members.join(giants, "root", "left_semi"), "rep"), ["tree", "root"], SPLIT_ROWS
    ).select("rep", "r1", "r2")
    # The same id may stand on several rows; its class was formed from one of them.
    texts = (
        docs.select(F.col("doc_id").alias("rep"), "text")
        .join(members.select("rep"), "rep", "left_semi")
    )
    sets = materialise(spark, _sets_of(texts, size).distinct(), "sets")
    blocks = whole.union(split).join(sets, "rep")
    final = components(spark, _confirmed_edges(blocks, percent))

    return (
        prints.join(classes.select(*key, "rep"), key, "left")
        .join(final.select(F.col("id").alias("rep"), "root"), "rep", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("doc_id").isNull(), F.lit(None))
            .otherwise(F.coalesce("root", "rep", "doc_id"))
            .cast("bigint")
            .alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )
