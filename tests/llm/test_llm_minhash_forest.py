from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest

from tillgrain.llm import minhash_forest
from tillgrain.llm.components import components
from tillgrain.llm.words import shingles

SCHEMA = "doc_id bigint, text string"


def brute_force(rows, size, percent):
    """component of each id, from all pairs of sets of word tuples"""
    sets = {}
    for i, text in rows:
        words = (text or "").encode().lower().split()
        grams = {tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))}
        sets[i] = grams if words else set()
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    shared, holders = Counter(), defaultdict(list)
    for i, grams in sets.items():
        for g in grams:
            shared.update((j, i) for j in holders[g])
            holders[g].append(i)
    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in sets}, {i: len(s) for i, s in sets.items()}


def near_copies(seed, groups=8, members=14, words=90):
    """chains of edited copies around the threshold, and unrelated texts"""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(4000)]
    rows = []
    for _ in range(groups):
        family = [[rng.choice(vocabulary) for _ in range(words)]]
        while len(family) < members:
            text = list(rng.choice(family))
            for _ in range(rng.randrange(1, 5)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            family.append(text)
        rows += family
    rng.shuffle(rows)
    return [(k, " ".join(t)) for k, t in enumerate(rows)]


def check(spark, rows, size=3, percent=85):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = minhash_forest.near_duplicates(spark, docs, size, percent).collect()
    want, sizes = brute_force(rows, size, percent)
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert {r["doc_id"]: r["n_shingles"] for r in got} == sizes
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_components_of_edited_copies_match_brute_force(spark):
    check(spark, near_copies(1))


def test_regions_and_blocks_beyond_their_bounds_stay_whole(spark, monkeypatch):
    monkeypatch.setattr(minhash_forest, "REGION_ROWS", 12)
    monkeypatch.setattr(minhash_forest, "BLOCK_ROWS", 12)
    monkeypatch.setattr(minhash_forest, "SPLIT_ROWS", 12)
    rows = near_copies(2, groups=3, members=40)
    check(spark, rows)


def around_a_far_text(seed, members=60, words=120):
    """texts whose only links are pairs, around one of the smallest id linked with none"""
    rng = random.Random(seed)
    base = [f"b{k}" for k in range(words)]
    rows = [(0, " ".join(base))]
    for k in range(members):
        text = list(base)
        for at in rng.sample(range(0, words, 3), 14):
            text[at] = f"n{k}x{at}"
        rows.append((10 + k, " ".join(text)))
        text[rng.randrange(words)] = "other"
        rows.append((5000 - k, " ".join(text)))
    return rows


def test_members_of_an_over_full_region_meet_without_its_smallest(spark, monkeypatch):
    monkeypatch.setattr(minhash_forest, "REGION_ROWS", 8)
    monkeypatch.setattr(minhash_forest, "BLOCK_ROWS", 8)
    monkeypatch.setattr(minhash_forest, "SPLIT_ROWS", 8)
    # All trees read the same values: one slicing of the region decides alone.
    monkeypatch.setattr(minhash_forest, "_tree_rows", one_region)
    rows = around_a_far_text(4)
    assert len(set(brute_force(rows, 3, 85)[0].values())) > 50
    check(spark, rows)


def one_region(classes):
    return classes.selectExpr("rep", "0 as tree", "1L as p4", "1L as p8")


def test_an_over_full_region_keeps_pairs_that_agree_no_deeper(spark, monkeypatch):
    monkeypatch.setattr(minhash_forest, "REGION_ROWS", 8)
    monkeypatch.setattr(minhash_forest, "BLOCK_ROWS", 8)
    monkeypatch.setattr(minhash_forest, "SPLIT_ROWS", 8)
    monkeypatch.setattr(
        minhash_forest,
        "_tree_rows",
        lambda classes: classes.selectExpr("rep", "0 as tree", "1L as p4", "rep as p8"),
    )
    check(spark, around_a_far_text(5, members=25))


def test_five_words_and_four_fifths(spark):
    check(spark, near_copies(3, groups=4), size=5, percent=80)


def test_documents_of_the_small_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check(spark, [tuple(r) for r in rows.select("doc_id", "text").collect()])


def test_edge_rows(spark):
    rows = [
        (5, None), (6, ""), (7, " \n\t"), (8, "One word"), (3, "one WORD"), (9, "word one"),
        (11, "É a b"), (12, "é a b"), (None, "one word"), (20, "x " * 30_000), (21, "X " * 29_000),
        (30, "same row here"), (30, "same row here"), (31, "a b c"), (32, "a b c"),
    ]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr(
        "*", "'k' as kept", "1 as component_id", "2 as rep", "3 as n_shingles"
    )
    got = defaultdict(list)
    for r in minhash_forest.near_duplicates(spark, docs, 3, 85).collect():
        got[r["doc_id"]].append((r["n_shingles"], r["component_id"], r["kept"]))
    assert got[5] == [(0, 5, True)] and got[6] == [(0, 6, True)] and got[7] == [(0, 7, True)]
    assert got[8] == [(1, 3, False)] and got[3] == [(1, 3, True)] and got[9] == [(1, 9, True)]
    assert got[11] == [(1, 11, True)] and got[12] == [(1, 12, True)]
    assert got[None] == [(1, None, True)]
    assert got[20] == [(1, 20, True)] and got[21] == [(1, 20, False)]
    assert got[30] == [(1, 30, True)] * 2
    assert got[31][0][1] == 31 and got[32][0][1] == 32


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    got = minhash_forest.near_duplicates(spark, docs)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"] and got.count() == 0


@pytest.mark.parametrize("n", [1, 2, 40])
def test_components_of_paths_and_hubs(spark, n):
    path = [(k, k + 1) for k in range(100, 100 + n)]
    hub = [(7, k) for k in range(1000, 1000 + 5 * n)]
    got = components(spark, spark.createDataFrame(path + hub, "a bigint, b bigint")).collect()
    roots = {r["id"]: r["root"] for r in got}
    assert len(got) == len(roots)
    assert {roots[k] for k in range(100, 101 + n)} == {100}
    assert {roots[k] for k in [7, *range(1000, 1000 + 5 * n)]} == {7}


def test_shingles_are_distinct_runs():
    assert shingles(b"", 3).size == 0
    assert shingles(b"a b a b a b", 3).size == 2
    assert (shingles(b"A b", 3) == shingles(b" a\n B ", 3)).all()
    assert shingles(b"a b", 3) != shingles(b"ab", 3)
