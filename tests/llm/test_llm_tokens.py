from __future__ import annotations

import hashlib
import itertools
import json
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

import corpus_pipeline
from tillgrain.llm import bpe, packing, queries
from tillgrain.llm.pretokens import pretokens

SCHEMA = "doc_id bigint, text string"
TEXTS = [
    None, "", " ", "  ", "a  b", " lead", "trail ", "a \nb", "\n\n x", "don't 're x'LL", "\x1c a", "a\x85 b\xa0c",
    "١٢ ½²x", "日本語 テキスト", "a\tb  \t c", "x" * 3000, "é" * 999, " " * 50, "<|endoftext|> <|x|>", "🙂🙂 ok ​",
    "word " * 4000,
]


@pytest.fixture(scope="module")
def entries():
    return bpe.read_ranks(public_tokenizers.path(bpe.VOCABULARY))


@pytest.fixture(scope="module")
def reference(entries):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=dict(entries), special_tokens={}
    )


def test_perfect_hash_is_minimal_and_finds_entries_only(entries):
    table = bpe.PerfectHash(entries)
    assert len(table.keys) == len(entries) and set(table.keys) == {k for k, _ in entries}
    assert all(table.get(key) == rank for key, rank in entries)
    assert all(table.get(key + b"\x00q\x00") is None for key, _ in entries[:500])


def test_merge_follows_ranks_leftmost_first(entries, reference):
    ranks = dict(entries)
    rng = random.Random(1)
    for _ in range(300):
        # Letters alone are one pre-token.
        word = "".join(rng.choice("abcdeéß日") for _ in range(rng.randrange(1, 30)))
        if word.encode() not in ranks:
            assert bpe.merge(word.encode(), ranks.get) == reference.encode_ordinary(word)


def test_ascii_pattern_splits_alike():
    import regex

    split = regex.compile(public_tokenizers.PATTERN).findall
    rng = random.Random(2)
    for _ in range(500):
        text = "".join(rng.choice("ab'sltre 12.,\n\t\x1c\x0b!_") for _ in range(40))
        assert pretokens(text) == split(text)


def test_digests_match_the_library(spark, reference):
    small = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    texts = TEXTS + [r["text"] for r in small]
    rows = [(None if i == 3 else i // 2, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as ids", "1 as n_tokens")
    got = Counter(tuple(r) for r in bpe.digests(docs).collect())
    want = Counter()
    for i, text in rows:
        ids = reference.encode_ordinary(text or "")
        want[(
            i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest(),
        )] += 1
    assert got == want


def test_encoding_an_empty_table(spark):
    assert bpe.digests(spark.createDataFrame([], SCHEMA)).count() == 0
    assert packing.pack_documents(spark, spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize(
    "histogram",
    [
        {}, {1: 3}, {1024: 7, 513: 9}, {600: 100, 500: 10, 424: 90, 300: 5},
        dict(Counter(np.random.default_rng(1).integers(1, 1025, 3000).tolist())),
        dict(Counter(np.minimum(1024, np.random.default_rng(2).lognormal(5.5, 1, 5000).astype(int) + 1).tolist())),
    ],
)
def test_plan_holds_every_piece_in_few_sequences(histogram):
    plan = packing.configurations(histogram)
    held, sequences = Counter(), 0
    for lengths, times in plan:
        assert sum(lengths) <= packing.CAPACITY and times > 0
        held.update({n: k * times for n, k in Counter(lengths).items()})
        sequences += times
    assert held == histogram
    # No worse than best fit by decreasing length.
    rooms, used = Counter(), 0
    for length in sorted(Counter(histogram).elements(), reverse=True):
        room = min((r for r in rooms if r >= length and rooms[r]), default=None)
        if room is None:
            used, room = used + 1, packing.CAPACITY
        else:
            rooms[room] -= 1
        rooms[room - length] += 1
    assert sequences <= used


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_the_program_is_near_its_bound_and_rounding_keeps_it(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    cut = packing.pieces(packing.tokenised(docs)).groupBy("length").count().collect()
    shorter = {r["length"]: r["count"] for r in cut if r["length"] < packing.CAPACITY}
    weights = packing.solve_program(shorter)
    held = Counter()
    for made, weight in weights.items():
        assert sum(made.places()) <= packing.CAPACITY
        for length, count in zip(made.lengths, made.counts, strict=True):
            held[length] += weight * count
    assert all(abs(held[n] - count) < 1e-3 for n, count in shorter.items())
    # No packing, fractional or not, is below the volume.
    bound = sum(n * count for n, count in shorter.items()) / packing.CAPACITY
    assert bound - 1e-6 <= sum(weights.values()) <= 1.01 * bound + 1
    down, rest = packing.round_program(shorter, weights)
    assert sum(down.values()) + sum(rest.values()) <= 1.01 * bound + 1
    assert sum(down.values()) >= 9 * sum(rest.values())


def test_knapsack_against_every_multiset():
    rng = np.random.default_rng(3)
    for _ in range(40):
        lengths = np.sort(rng.choice(np.arange(1, 20), 4, replace=False))
        prices, most = rng.random(4), rng.integers(1, 6, 4)
        got = packing._best_configuration(lengths, prices, most, 30)
        assert (got <= most).all() and got @ lengths <= 30
        every = itertools.product(*(range(m + 1) for m in most))
        best = max(np.dot(c, prices) for c in every if np.dot(c, lengths) <= 30)
        assert abs(got @ prices - best) < 1e-9


def test_packing_keeps_the_contract(spark):
    small = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    rows = list(enumerate(TEXTS + [r["text"] for r in small]))
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "5 as length", "6 as rank")
    got = packing.pack_documents(spark, docs).toPandas()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    for i, text in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        own = got[got.doc_id == i].sort_values("piece")
        assert own.piece.tolist() == list(range(len(own)))
        assert own.length.sum() == ids.size and (own.length[1:] == 1024).all()
        assert (own.start == own.length.cumsum() - own.length).all()
        for start, length, crc in zip(own.start, own.length, own.ids_crc32, strict=True):
            assert zlib.crc32(ids[start : start + length].tobytes()) == crc
    got = got.sort_values(["sequence_id", "offset"])
    ends = got.groupby("sequence_id").length.cumsum()
    assert (got.offset == ends - got.length).all() and ends.max() <= 1024
    assert got.sequence_id.nunique() <= 1.01 * got.length.sum() / 1024 + 1


def test_added_tokens_are_read_as_the_library_does(spark, tmp_path):
    texts = [*TEXTS, "a <|endoftext|> b", "x<|endoftext|><|endoftext|>\n y", "a  <|endoftext|>  b's"]
    spark.createDataFrame(list(enumerate(texts)), SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = [np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], "<u4") for t in texts]
    for rows in (
        queries.op3_packing(spark, str(tmp_path)),
        corpus_pipeline.packed(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path)),
    ):
        got = {(r["doc_id"], r["start"]): (r["length"], r["ids_crc32"]) for r in rows.collect()}
        assert {i for i, _ in got} == set(range(len(texts)))
        for (i, start), (length, crc) in got.items():
            assert zlib.crc32(want[i][start : start + length].tobytes()) == crc
        for i, ids in enumerate(want):
            assert sum(n for (k, _), (n, _) in got.items() if k == i) == ids.size


def test_repeated_rows_are_packed_one_by_one(spark):
    docs = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (None, "a b c")], SCHEMA)
    got = packing.pack_documents(spark, docs).collect()
    assert len(got) == 3 and len({(r["sequence_id"], r["offset"]) for r in got}) == 3


def test_sequences_hold_the_ids(spark):
    docs = spark.createDataFrame([(1, "one two"), (2, "three"), (3, "word " * 3000)], SCHEMA)
    got = packing.sequences(spark, docs).collect()
    sizes = sorted(len(r["ids"]) // 4 for r in got)
    assert max(sizes) <= 1024
    tokens = sum(len(r["ids"]) // 4 for r in packing.tokenised(docs).collect())
    assert sum(sizes) == tokens


def test_rank_encoder_equals_the_library_on_odd_texts():
    with open(public_tokenizers.path(packing.VOCABULARY), encoding="utf-8") as file:
        model = file.read()
    assert packing._ranks(json.loads(model)) is not None
    library = Tokenizer.from_str(model)
    texts = ["", " ", "a" * 5000, "\n \t" * 900, " " * 1500 + "x", "é漢字🙂 ' s 's12", "\x00\x7f\xa0"]
    texts += [" " * 1_200_000 + "x", "don't  stop\r\n\r\nnow ½"]
    encode = packing._encoder(model, False)
    for text in texts:
        ids = np.frombuffer(encode(text), "<u4").tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids
    mark = library.get_added_tokens_decoder()[50256].content
    library.encode_special_tokens = True
    plain = library.encode(f"a {mark} b", add_special_tokens=False).ids
    assert np.frombuffer(encode(f"a {mark} b"), "<u4").tolist() == plain
    assert 50256 in np.frombuffer(packing._encoder(model, True)(f"a {mark} b"), "<u4").tolist()
