"""Best-fit packing of token pieces into sequences by a configuration linear program.

Only the histogram of piece lengths decides which pieces share a sequence. A
configuration is a multiset of lengths that fits; the program asks for weights of
configurations that cover the histogram with the least total weight. It is solved by
multiplicative weights: a length that lags behind grows in price, and each round's
configuration is the best-priced one, found by a knapsack over the capacity. The rounds go
on until their weights hold the whole histogram. The weights are rounded down, and the
pieces of the dropped fractions are solved again in whole uses.

The histogram has one row per length, so the solver's input and output do not grow with
the corpus. Its configurations name slots: the pieces of one length are numbered by a
grouped count and a ranking inside hash groups of bounded size, and each number is
looked up in the slots of its length. No piece passes through the driver.

Defined cases: a null text is an empty one and is packed as its end token alone. Rows
without an id, and repeated rows, are packed like others. Columns besides doc_id and
text are ignored; an empty table gives no pieces.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillgrain.llm.support import importable, map_batches, materialise

VOCABULARY = "byte_bpe_50k.json"
CAPACITY = 1024
END_TOKEN = 2
# Share of the uses left to a configuration that one round takes, the rate at which prices
# follow the lag of a length, and how much dearer than its share a whole sequence starts.
STEP = 0.9
RATE = 0.1
LONG_PIECES = 1.0
# Fractions of a piece below this are rounding errors of the weights.
_NOTHING = 1e-6
# From so few uses on, a round takes all of them: their parts would be lost in rounding.
_FEW = 10
# Pieces of one length that a hash group holds on average; the number of groups grows.
GROUP_ROWS = 20_000

# The alphabet of byte-level vocabularies: printable bytes stand for themselves, the
# others take the code points from 256 on in their order.
_PRINTABLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_BYTE_LETTERS = {
    byte: 256 + k for k, byte in enumerate(b for b in range(256) if b not in _PRINTABLE)
}

# The rank encoder's pattern overflows its stack on very long runs of white space.
_LONG_BLANK = re.compile(r"\s{1000}")

_ENCODERS: dict[str, tuple[Callable[[str], bytes], Callable[[str], bytes | None]]] = {}


def _ranks(spec: dict) -> dict[bytes, int] | None:
    """Bytes to id, if ids rise in the order of merges, so that a merge's rank is its id."""
    vocabulary = spec["model"]["vocab"]
    merges = [m if isinstance(m, str) else "".join(m) for m in spec["model"]["merges"]]
    made = [vocabulary[m.replace(" ", "")] for m in merges]
    if any(a >= b for a, b in zip(made, made[1:], strict=False)):
        return None
    byte_of = {chr(letter): byte for byte, letter in _BYTE_LETTERS.items()}
    byte_of |= {chr(b): b for b in _PRINTABLE}
    added = {t["content"] for t in spec["added_tokens"]}
    return {
        bytes(byte_of[c] for c in word): i for word, i in vocabulary.items() if word not in added
    }


def _by_library(model: str, special: bool) -> Callable[[str], bytes]:
    """The tokenizer library itself, loaded when the first text needs it."""
    loaded: list[Tokenizer] = []

    def encode(text: str) -> bytes:
        if not loaded:
            loaded.append(Tokenizer.from_str(model))
            loaded[0].encode_special_tokens = not special
        ids = loaded[0].encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    return encode


def _encoder(model: str, added_tokens: bool) -> Callable[[str], bytes]:
    """One tokenizer per worker process. It keeps no memory of texts.

    Ordinary text goes through the ranks of the file's merges. The tokenizer library takes texts
    that hold an added token where those count, and a file whose ids do not follow its merges.
    """
    if model not in _ENCODERS:
        _ENCODERS.clear()
        spec = json.loads(model)
        marks = [t["content"] for t in spec["added_tokens"]]
        ranks = _ranks(spec)
        del spec
        by_library, with_added = _by_library(model, False), _by_library(model, True)

        def whole(text: str) -> bytes | None:
            """The library's own ids of a text that holds an added token."""
            return with_added(text) if any(mark in text for mark in marks) else None

        if ranks is None:
            _ENCODERS[model] = by_library, whole
        else:
            encode = tiktoken.Encoding(
                "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
            ).encode_ordinary

            def ordinary(text: str) -> bytes:
                if _LONG_BLANK.search(text):
                    return by_library(text)
                return np.array(encode(text), dtype="<u4").tobytes()

            _ENCODERS[model] = ordinary, whole
    ordinary, whole = _ENCODERS[model]
    if not added_tokens:
        return ordinary
    return lambda text: ordinary(text) if (ids := whole(text)) is None else ids


def tokenised(
    docs: DataFrame, path: str | None = None, added_tokens: bool = False
) -> DataFrame:
    """(doc_id, ids): the text's ids and the end token, little-endian unsigned 32-bit.

    With ``added_tokens``, those of the file (``<|endoftext|>``) are read in a text as
    their own ids, as the library does by default; otherwise they are ordinary text.
    """
    spark = docs.sparkSession
    importable(spark)
    with open(path or public_tokenizers.path(VOCABULARY), encoding="utf-8") as model:
        shared = spark.sparkContext.broadcast(model.read())
    end = np.array([END_TOKEN], dtype="<u4").tobytes()

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        encode = _encoder(shared.value, added_tokens)
        for batch in batches:
            ids = [encode(t or "") + end for t in batch.column(1).to_pylist()]
            yield {"doc_id": batch.column(0), "ids": pa.array(ids, pa.binary())}

    return map_batches(docs.select("doc_id", "text"), step, "doc_id bigint, ids binary")


def pieces(encoded: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): longer documents cut, the first piece short."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            rows, piece, start, length, crc = [], [], [], [], []
            for row, packed in enumerate(batch.column(1).to_pylist()):
                n = len(packed) // 4
                at, k = 0, 0
                while at < n:
                    size = (n - at - 1) % capacity + 1 if k == 0 else capacity
                    rows.append(row)
                    piece.append(k)
                    start.append(at)
                    length.append(size)
                    crc.append(zlib.crc32(packed[4 * at : 4 * (at + size)]))
                    at, k = at + size, k + 1
            yield {
                "doc_id": batch.column(0).take(pa.array(rows, pa.int64())) if rows else ids[:0],
                "piece": pa.array(piece, pa.int32()),
                "start": pa.array(start, pa.int64()),
                "length": pa.array(length, pa.int64()),
                "ids_crc32": pa.array(crc, pa.int64()),
            }

    return map_batches(
        encoded.select("doc_id", "ids"),
        step,
        "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint",
    )


# -- the configuration program, on the histogram ----------------------------------


@dataclass(frozen=True)
class Configuration:
    """One sequence's pieces: lengths, longest last, and how many of each."""

    lengths: tuple[int, ...]
    counts: tuple[int, ...]

    def places(self) -> list[int]:
        return np.repeat(self.lengths, self.counts)[::-1].tolist()


def _best_configuration(
    lengths: np.ndarray, prices: np.ndarray, most: np.ndarray, capacity: int
) -> np.ndarray:
    """Counts per length, at most ``most``, of the best-priced multiset that fits.

    A knapsack over the capacity. The copies of a length are offered in lots of 1, 2, 4 ...
    and what is left, which add up to every number of copies.
    """
    best = np.zeros(capacity + 1)
    lots = []
    for i, length in enumerate(lengths.tolist()):
        left, copies = min(int(most[i]), capacity // length), 1
        while left > 0:
            copies = min(copies, left)
            size = copies * length
            value = best[:-size] + copies * prices[i]
            better = value > best[size:]
            best[size:][better] = value[better]
            lots.append((i, copies, size, better))
            left, copies = left - copies, 2 * copies
    counts, room = np.zeros(lengths.size, dtype=np.int64), capacity
    for i, copies, size, better in reversed(lots):
        if room >= size and better[room - size]:
            counts[i] += copies
            room -= size
    return counts


def solve_program(
    histogram: dict[int, int], capacity: int = CAPACITY, whole: bool = False
) -> dict[Configuration, float]:
    """Weights of configurations that hold exactly the histogram's pieces: the fractional program.

    Multiplicative weights. A length's price is its share of a sequence, long ones somewhat
    dearer as they are harder to place, times an exponential of the share of its pieces that
    lags behind the rest. Each round takes the best-priced configuration among those that
    what is left can fill, and uses it for ``STEP`` of what would exhaust one of its lengths,
    or all of it when that is little, so that no round is held up by the rarest length. Rounds
    go on until everything is held. With ``whole``, every use is a whole sequence.
    """
    lengths = np.array([n for n in sorted(histogram) if histogram[n]], dtype=np.int64)
    demand = np.array([histogram[n] for n in lengths.tolist()], dtype=float)
    start = lengths * (1 + LONG_PIECES * lengths / capacity)
    left, tokens = demand.copy(), float(demand @ lengths)
    weights: dict[Configuration, float] = {}
    while (some := np.flatnonzero(left > _NOTHING)).size:
        lag = left[some] / demand[some] - left @ lengths / tokens
        counts = _best_configuration(
            lengths[some], start[some] * np.exp(RATE * lag), np.ceil(left[some] - _NOTHING), capacity
        )
        used = some[counts > 0]
        counts = counts[counts > 0]
        most = (left[used] / counts).min()
        uses = STEP * most if most > _FEW else most
        if whole:
            uses = int(uses)
        made = Configuration(tuple(lengths[used].tolist()), tuple(counts.tolist()))
        weights[made] = weights.get(made, 0) + uses
        left[used] = np.maximum(left[used] - uses * counts, 0)
    return weights


def round_program(
    histogram: dict[int, int], weights: dict[Configuration, float], capacity: int = CAPACITY
) -> tuple[dict[Configuration, int], dict[Configuration, int]]:
    """Whole uses of the fractional solution, and of the program of what these leave.

    Weights are rounded down, which drops less than one use of each configuration. The pieces
    of the uses dropped are a small histogram again, solved in whole uses.
    """
    left, down = dict(histogram), {}
    for made, weight in weights.items():
        parts = list(zip(made.lengths, made.counts, strict=True))
        uses = min([int(weight + _NOTHING), *(left[n] // k for n, k in parts)])
        if uses:
            down[made] = uses
            for n, k in parts:
                left[n] -= uses * k
    rest = solve_program(left, capacity, whole=True)
    return down, {made: int(uses) for made, uses in rest.items()}


def configurations(
    histogram: dict[int, int], capacity: int = CAPACITY
) -> list[tuple[list[int], int]]:
    """[(lengths in one sequence, sequences)] that hold every piece of the histogram.

    The plan has exactly as many slots of each length as there are pieces.
    """
    full = histogram.get(capacity, 0)
    shorter = {n: count for n, count in histogram.items() if n != capacity and count}
    down, rest = round_program(shorter, solve_program(shorter, capacity), capacity)
    plan = [([capacity], full)] if full else []
    return plan + [(made.places(), uses) for part in (down, rest) for made, uses in part.items()]


def _slots(plan: list[tuple[list[int], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, offset).

    A place in a configuration used t times takes t pieces of its length.
    """
    rows, rank, sequence = [], {}, 0
    for lengths, times in plan:
        offset = 0
        for length in lengths:
            low = rank.get(length, 0)
            rows.append((length, low, low + times, sequence, offset))
            rank[length] = low + times
            offset += length
        sequence += times
    return rows


def numbered(cut: DataFrame, total: int) -> DataFrame:
    """``cut`` with ``rank``: a number from 0 within each length, without a global sort."""
    groups = total // GROUP_ROWS + 1
    own = F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32"), F.lit(groups))
    cut = cut.withColumn("_group", own)
    sizes = cut.groupBy("length", "_group").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("_group").rowsBetween(
        Window.unboundedPreceding, -1
    )
    sizes = sizes.withColumn("_base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    # Rows equal in all of these are one piece, so a task run again deals the same places.
    inside = Window.partitionBy("length", "_group").orderBy(
        "doc_id", "piece", "start", "ids_crc32"
    )
    ranked = cut.withColumn("_inside", F.row_number().over(inside) - 1)
    return ranked.join(sizes, ["length", "_group"]).withColumn(
        "rank", F.col("_base") + F.col("_inside")
    )


def pack(spark: SparkSession, cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``cut`` (doc_id, piece, start, length, ids_crc32) with sequence_id and offset."""
    histogram = {
        row["length"]: row["n"]
        for row in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    }
    slots = spark.createDataFrame(
        _slots(configurations(histogram, capacity)),
        "length bigint, low bigint, high bigint, sequence bigint, offset bigint",
    )
    # One array of slots per length, ordered by rank: a lookup, not a range join.
    by_length = F.broadcast(
        slots.groupBy("length").agg(
            F.sort_array(F.collect_list(F.struct("low", "high", "sequence", "offset"))).alias(
                "slots"
            )
        )
    )
    ranked = numbered(cut, sum(histogram.values()))
    slot: Column = F.filter("slots", lambda s: (F.col("rank") >= s["low"]) & (F.col("rank") < s["high"]))[0]
    return (
        ranked.join(by_length, "length")
        .withColumn("_slot", slot)
        .select(
            "doc_id",
            "piece",
            "start",
            "length",
            "ids_crc32",
            (F.col("_slot.sequence") + F.col("rank") - F.col("_slot.low")).alias("sequence_id"),
            F.col("_slot.offset").alias("offset"),
        )
    )


def pack_documents(
    spark: SparkSession,
    docs: DataFrame,
    capacity: int = CAPACITY,
    path: str | None = None,
    added_tokens: bool = False,
) -> DataFrame:
    """Tokenise, cut and pack every document; one row per piece."""
    cut = materialise(spark, pieces(tokenised(docs, path, added_tokens), capacity), "pieces")
    return pack(spark, cut, capacity)


def sequences(
    spark: SparkSession, docs: DataFrame, capacity: int = CAPACITY, added_tokens: bool = False
) -> DataFrame:
    """(sequence_id, ids): the token ids of every packed sequence, in order."""
    encoded = materialise(spark, tokenised(docs, added_tokens=added_tokens), "tokens")
    placed = pack(spark, materialise(spark, pieces(encoded, capacity), "pieces"), capacity)
    part = F.expr("substring(ids, cast(4 * start + 1 as int), cast(4 * length as int))")
    return (
        placed.join(encoded, "doc_id")
        .groupBy("sequence_id")
        .agg(F.sort_array(F.collect_list(F.struct("offset", part.alias("ids")))).alias("parts"))
        .select("sequence_id", F.expr("array_join(transform(parts, p -> hex(p.ids)), '')").alias("h"))
        .select("sequence_id", F.unhex("h").alias("ids"))
    )
