"""Vector code compression: product codebooks fitted and applied over tries of vector parts.

Every component x becomes the integer floor(1024 x); a vector is cut into ``PARTS`` equal
consecutive parts. Each part position has a codebook of at most 256 entries, first that part of the
vectors of the smallest ids. A round assigns every part to the nearest entry (squared
distance, ties to the lower index) and replaces an entry by the floor of its parts' mean.

The distinct parts of a lot of rows stand in lexicographic order, which is a trie: its
nodes are ranges of parts with a common prefix. A depth-first walk keeps, for the prefix
so far, the squared distances to all 256 entries; children add their one dimension to the vector
they share. Neighbouring subtrees of at most ``LEAVES`` parts together are taken level by
level, each distinct prefix once. A leaf takes the nearest entry, and adds its part, times the rows that hold
it, to the sums of that entry. Sums of counts and components are all that leaves a task.

Defined cases: vectors that are null or hold null or non-finite components take no part.
Vectors whose length is not that of the longest, or not a multiple of ``PARTS``, are read as if
zeros followed. Components beyond ±2^20 count as that bound, so that no sum overflows. With
fewer than 256 rows the codebooks have as many entries as there are rows; ids that repeat are
ordered by vector, rows without an id come last. An empty table gives an empty result.
Columns besides vec_id, embedding and label are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillgrain.llm.support import map_batches, materialise

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
LARGEST = float(1 << 20)
LEAVES = 512
# Rows whose parts form one trie.
LOT = 8192
# Labels of more rows than this are few; their sums are broadcast instead of shuffled.
HEAVY_LABEL = 1_000_000


def whole_numbers(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, v): rows that take part, v as an array of ints."""
    usable = F.col("embedding").isNotNull() & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    whole = F.transform(
        "embedding",
        lambda x: F.floor(
            F.least(F.greatest(x.cast("double"), F.lit(-LARGEST)), F.lit(LARGEST)) * SCALE
        ).cast("int"),
    )
    label = F.col("label") if "label" in vectors.columns else F.lit(None).cast("int")
    return vectors.where(usable).select("vec_id", label.alias("label"), whole.alias("v"))


def _matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    """The vectors as rows, zeros after the shorter ones."""
    column = batch.column(batch.schema.get_field_index("v"))
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    length = np.diff(column.offsets.to_numpy(zero_copy_only=False))
    if (length == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((length.size, width), dtype=np.int64)
    row = np.repeat(np.arange(length.size), length)
    out[row, np.arange(flat.size) - np.repeat(np.cumsum(length) - length, length)] = flat
    return out


def _heads(parts: np.ndarray) -> np.ndarray:
    """For sorted parts, the first dimension in which each differs from the one before."""
    differs = parts[1:] != parts[:-1]
    first = np.where(differs.any(axis=1), differs.argmax(axis=1), parts.shape[1])
    return np.concatenate([[0], first])


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of and squared distance to the nearest entry, for sorted distinct parts."""
    n, width = parts.shape
    span = int(max(np.abs(parts).max(initial=0), np.abs(entries).max(initial=0)))
    # Narrow numbers where no sum can overflow them.
    kind = np.int32 if width * (2 * span) ** 2 < 2**31 else np.int64
    parts, entries = parts.astype(kind), np.ascontiguousarray(entries.T.astype(kind))
    heads = _heads(parts)
    code, error = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    # Depth first: ranges of parts with a common prefix and the distances of that prefix.
    open_nodes = [(0, n, 0, np.zeros(entries.shape[1], dtype=kind))]
    while open_nodes:
        low, high, depth, shared = open_nodes.pop()
        if high - low > LEAVES and depth < width:
            cuts = low + 1 + np.flatnonzero(heads[low + 1 : high] <= depth)
            begin = low
            for a, b in zip([low, *cuts.tolist()], [*cuts.tolist(), high], strict=True):
                # Small neighbours go on together from the prefix they share.
                if b - begin > LEAVES and a > begin:
                    open_nodes.append((begin, a, depth, shared))
                    begin = a
                if b - a > LEAVES:
                    step = entries[depth] - parts[a, depth]
                    open_nodes.append((a, b, depth + 1, shared + step * step))
                    begin = b
            if begin < high:
                open_nodes.append((begin, high, depth, shared))
            continue
        # Small subtrees level by level; ``node`` is the place of each part's prefix.
        total, node = shared[None, :], np.zeros(high - low, dtype=np.int64)
        for at in range(depth, width):
            fresh = heads[low:high] <= at
            fresh[0] = True
            first = np.flatnonzero(fresh)
            step = entries[at][None, :] - parts[low + first, at][:, None]
            np.multiply(step, step, out=step)
            step += total[node[first]]
            total, node = step, np.cumsum(fresh) - 1
        best = total.argmin(axis=1)
        code[low:high] = best[node]
        error[low:high] = total[np.arange(best.size), best][node]
    return code, error


def _trie_order(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct parts in lexicographic order, and which one each row has."""
    order = np.lexsort(parts.T[::-1]) if parts.shape[1] else np.arange(parts.shape[0])
    ordered = parts[order]
    fresh = np.ones(order.size, dtype=bool)
    fresh[1:] = (ordered[1:] != ordered[:-1]).any(axis=1)
    which = np.empty(order.size, dtype=np.int64)
    which[order] = np.cumsum(fresh) - 1
    return ordered[fresh], which


def _lots(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[list, np.ndarray]]:
    """Batches together, with their vectors, in lots of about ``LOT`` rows."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) >= LOT:
            yield held, np.vstack([_matrix(b, width) for b in held])
            held = []
    if held:
        yield held, np.vstack([_matrix(b, width) for b in held])


def _sums(whole: DataFrame, books: np.ndarray) -> dict[tuple[int, int], tuple[int, np.ndarray]]:
    """Per (part, entry) in use: number of parts assigned, and their componentwise sums."""
    sent = whole.sparkSession.sparkContext.broadcast(books)
    n_parts, n_entries, width = books.shape

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        entries = sent.value
        count = np.zeros((n_parts, n_entries), dtype=np.int64)
        total = np.zeros(books.shape, dtype=np.int64)
        for _, vectors in _lots(batches, n_parts * width):
            for p in range(n_parts):
                parts, which = _trie_order(vectors[:, p * width : (p + 1) * width])
                rows = np.bincount(which, minlength=parts.shape[0])
                code, _ = nearest(parts, entries[p])
                np.add.at(count[p], code, rows)
                np.add.at(total[p], code, parts * rows[:, None])
        p, e = np.nonzero(count)
        yield {
            "part": p,
            "entry": e,
            "n": count[p, e],
            "total": total[p, e].tolist(),
        }

    partial = map_batches(
        whole.select("v"), step, "part bigint, entry bigint, n bigint, total array<bigint>"
    )
    # One row per dimension: sums meet in the shuffle, at most PARTS * 256 * width come back.
    n = partial.groupBy("part", "entry").agg(F.sum("n").alias("n"))
    sums = (
        partial.select("part", "entry", F.posexplode("total").alias("at", "x"))
        .groupBy("part", "entry", "at")
        .agg(F.sum("x").alias("x"))
        .groupBy("part", "entry")
        .agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "x"))), lambda s: s["x"]).alias("total"))
    )
    rows = n.join(sums, ["part", "entry"], "left").collect()
    return {(r["part"], r["entry"]): (r["n"], np.array(r["total"] or [], dtype=np.int64)) for r in rows}


def first_books(whole: DataFrame, width: int, parts: int = PARTS) -> np.ndarray:
    """Codebooks (part, entry, component) of the smallest ids."""
    # Ids alone first: what each task offers for the smallest ones is a few bytes a row.
    ids = [r[0] for r in whole.select("vec_id").orderBy(F.asc_nulls_last("vec_id")).limit(ENTRIES).collect()]
    known = [i for i in ids if i is not None]
    chosen = whole
    if len(ids) == ENTRIES and len(known) == ENTRIES:
        chosen = whole.where(F.col("vec_id") <= known[-1])
    rows = chosen.select("vec_id", "v").orderBy(F.asc_nulls_last("vec_id"), "v").limit(ENTRIES)
    vectors = np.zeros((len(ids), width), dtype=np.int64)
    for i, r in enumerate(rows.collect()):
        vectors[i, : len(r["v"])] = r["v"]
    return np.ascontiguousarray(vectors.reshape(len(ids), parts, width // parts).swapaxes(0, 1))


def fit(whole: DataFrame, width: int, parts: int = PARTS, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks after ``rounds`` rounds over all rows."""
    books = first_books(whole, width, parts)
    for _ in range(rounds):
        fresh = books.copy()
        for (p, e), (n, total) in _sums(whole, books).items():
            fresh[p, e] = total // n
        books = fresh
    return books


def encode(whole: DataFrame, books: np.ndarray) -> DataFrame:
    """(vec_id, label, code, error) of every row."""
    sent = whole.sparkSession.sparkContext.broadcast(books)
    n_parts, _, width = books.shape

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for held, vectors in _lots(batches, n_parts * width):
            codes = np.empty((vectors.shape[0], n_parts), dtype=np.uint8)
            errors = np.zeros(vectors.shape[0], dtype=np.int64)
            for p in range(n_parts):
                parts, which = _trie_order(vectors[:, p * width : (p + 1) * width])
                code, error = nearest(parts, sent.value[p])
                codes[:, p] = code[which]
                errors += error[which]
            hexed = codes.tobytes().hex()
            size = 2 * n_parts
            at = 0
            for batch in held:
                end = at + batch.num_rows
                yield {
                    "vec_id": batch.column(0),
                    "label": batch.column(1),
                    "code": [hexed[i * size : (i + 1) * size] for i in range(at, end)],
                    "error": errors[at:end],
                }
                at = end

    kinds = {f.name: f.dataType.simpleString() for f in whole.schema.fields}
    schema = f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error bigint"
    return map_batches(whole.select("vec_id", "label", "v"), step, schema)


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def with_label_error(spark: SparkSession, encoded: DataFrame) -> DataFrame:
    """The rows with the error of all rows of their label.

    A label that holds much of the table would send those rows to one task: the sums of
    such labels, at most one per ``HEAVY_LABEL`` rows, are broadcast and their rows stay.
    """
    stored = materialise(spark, encoded, "vector_codes")
    sums = materialise(
        spark,
        stored.groupBy("label").agg(
            F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("n")
        ),
        "label_errors",
    )
    heavy = sums.where((F.col("n") > HEAVY_LABEL) | F.col("label").isNull())
    light = sums.where((F.col("n") <= HEAVY_LABEL) & F.col("label").isNotNull())
    same = stored["label"].eqNullSafe(heavy["label"])
    columns = ["vec_id", "code", "error", "label_error"]
    few = F.broadcast(heavy)
    near = stored.join(few, same).select(*columns)
    rest = stored.join(few, same, "left_anti").join(light.drop("n"), "label").select(*columns)
    return near.unionByName(rest)


def compress(spark: SparkSession, vectors: DataFrame) -> DataFrame:
    """Code and error of every vector, and the digest of the fitted codebooks."""
    whole = whole_numbers(vectors)
    longest = whole.agg(F.max(F.size("v"))).first()[0] or 0
    width = -(-longest // PARTS) * PARTS
    books = fit(whole, width)
    out = with_label_error(spark, encode(whole, books))
    return out.withColumn("codebooks_sha256", F.lit(digest(books)))
