"""Byte-level BPE encoding and decoding with a two-tier lookup.

First tier: a minimal perfect hash (buckets with displacements) maps each of the n
vocabulary entries to its own slot 0 to n-1; one probe and one comparison tell whether a
whole pre-token is an entry. Second tier, for the others: the bytes form a linked list, a
heap holds the adjacent pairs that are entries by rank, and the best pair is joined until
none is left.

The vocabulary file is read on the driver and broadcast; its size is that of the
vocabulary. Texts never leave their row, so there is no shuffle.

Defined cases: a null text is an empty one, and an empty one has no ids. Rows without an
id and repeated rows are encoded like any other. Columns besides doc_id and text are
ignored.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import public_tokenizers
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillgrain.llm.pretokens import RememberingEncoder
from tillgrain.llm.support import importable, map_batches

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
_BUCKET = 1.5
_MASK, _STEP, _SPREAD = (1 << 64) - 1, 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9


def read_ranks(path: str) -> list[tuple[bytes, int]]:
    with open(path, "rb") as lines:
        return [(base64.b64decode(a), int(b)) for a, b in map(bytes.split, lines)]


class PerfectHash:
    """Entry to rank with one slot per entry and no empty slot."""

    def __init__(self, entries: list[tuple[bytes, int]]) -> None:
        n = self.size = len(entries)
        self.buckets = max(1, int(n / _BUCKET))
        members: list[list[int]] = [[] for _ in range(self.buckets)]
        hashes = [xxhash.xxh3_64_intdigest(key) for key, _ in entries]
        for i, h in enumerate(hashes):
            members[h % self.buckets].append(i)
        taken = [False] * n
        self.keys, self.ranks = [b""] * n, [0] * n
        # A displacement d >= 0 rehashes a bucket's keys; d < 0 names a slot.
        self.displacement = [0] * self.buckets
        free = iter(range(n))
        for bucket in sorted(range(self.buckets), key=lambda b: -len(members[b])):
            own = members[bucket]
            if not own:
                break
            if len(own) == 1:
                slot = next(s for s in free if not taken[s])
                self.displacement[bucket], slots = -slot - 1, [slot]
            else:
                d = 0
                while True:
                    slots = [self._slot(hashes[i], d) for i in own]
                    if len(set(slots)) == len(slots) and not any(taken[s] for s in slots):
                        break
                    d += 1
                self.displacement[bucket] = d
            for i, slot in zip(own, slots, strict=True):
                taken[slot] = True
                self.keys[slot], self.ranks[slot] = entries[i]

    def _slot(self, h: int, d: int) -> int:
        x = (h + d * _STEP) & _MASK
        return (((x ^ (x >> 29)) * _SPREAD) & _MASK) % self.size

    def get(self, key: bytes) -> int | None:
        """Rank of the entry, None if it is not one."""
        h = xxhash.xxh3_64_intdigest(key)
        d = self.displacement[h % self.buckets]
        slot = -d - 1 if d < 0 else self._slot(h, d)
        return self.ranks[slot] if self.keys[slot] == key else None


def merge(piece: bytes, rank_of) -> list[int]:
    """Ids of a pre-token that is no entry: join the best-ranked pair, leftmost first."""
    n = len(piece)
    following = list(range(1, n + 1))
    previous = list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        rank = rank_of(piece[i : i + 2])
        if rank is not None:
            heap.append((rank, i, i + 1, i + 2))
    heapify(heap)
    while heap:
        _, left, middle, end = heappop(heap)
        # Stale unless both parts still have the bounds they had when pushed.
        if following[left] != middle or middle >= n or following[middle] != end:
            continue
        following[left] = end
        following[middle] = -1
        if end < n:
            previous[end] = left
            after = following[end]
            rank = rank_of(piece[left:after])
            if rank is not None:
                heappush(heap, (rank, left, end, after))
        before = previous[left]
        if before >= 0:
            rank = rank_of(piece[before:end])
            if rank is not None:
                heappush(heap, (rank, before, left, end))
    ids, at = [], 0
    while at < n:
        ids.append(rank_of(piece[at : following[at]]))
        at = following[at]
    return ids


class Encoder:
    def __init__(self, table: PerfectHash) -> None:
        self._rank_of = table.get
        self._pair_rank = dict(zip(table.keys, table.ranks, strict=True)).get
        self._remembering = RememberingEncoder(lambda tokens: [self._pretoken(t) for t in tokens])

    def _pretoken(self, token: str) -> bytes:
        piece = token.encode()
        rank = self._rank_of(piece)
        ids = [rank] if rank is not None else merge(piece, self._pair_rank)
        return struct.pack(f"<{len(ids)}I", *ids)

    def __call__(self, text: str) -> bytes:
        return self._remembering(text)


_ENCODERS: dict[int, Encoder] = {}


def _encoder(shared) -> Encoder:
    """One encoder, and one memory, per worker process and broadcast vocabulary."""
    key = id(shared.value)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(shared.value)
    return _ENCODERS[key]


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids): ids as little-endian unsigned 32-bit integers."""
    spark = docs.sparkSession
    importable(spark)
    entries = read_ranks(path or public_tokenizers.path(VOCABULARY))
    shared = spark.sparkContext.broadcast(PerfectHash(entries))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        encoder = _encoder(shared)
        for batch in batches:
            ids = [encoder(t or "") for t in batch.column(1).to_pylist()]
            yield {
                "doc_id": batch.column(0),
                "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()),
                "ids": pa.array(ids, pa.binary()),
            }

    return map_batches(
        docs.select("doc_id", "text"), step, "doc_id bigint, n_tokens bigint, ids binary"
    )


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``encoded`` with ``decoded``, the bytes its ids stand for."""
    spark = encoded.sparkSession
    entries = read_ranks(path or public_tokenizers.path(VOCABULARY))
    pieces: list[bytes] = [b""] * (max(rank for _, rank in entries) + 1)
    for piece, rank in entries:
        pieces[rank] = piece
    shared = spark.sparkContext.broadcast(pieces)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        piece_of = shared.value.__getitem__
        for batch in batches:
            ids = [np.frombuffer(x, "<u4").tolist() for x in batch.column(2).to_pylist()]
            yield {
                "doc_id": batch.column(0),
                "n_tokens": batch.column(1),
                "ids": batch.column(2),
                "decoded": pa.array([b"".join(map(piece_of, x)) for x in ids], pa.binary()),
            }

    return map_batches(
        encoded.select("doc_id", "n_tokens", "ids"),
        step,
        "doc_id bigint, n_tokens bigint, ids binary, decoded binary",
    )


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Ids of every text and the bytes decoded from them, as digests."""
    return decode(encode(docs, path), path).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
