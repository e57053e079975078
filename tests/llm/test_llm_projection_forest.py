from __future__ import annotations

import numpy as np

from tillgrain.llm import projection_forest

SCHEMA = "vec_id bigint, embedding array<float>"


def nearest(ids, vectors, every, k):
    """exact: per query (vec_id, distance) of the k nearest other rows"""
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        d = np.sqrt(((vectors - vectors[i]) ** 2).sum(axis=1))
        d[i] = np.inf
        order = np.lexsort((ids, d))[: min(k, ids.size - 1)]
        out[int(ids[i])] = [(int(ids[j]), float(d[j])) for j in order]
    return out


def found(spark, vectors, every, k=10):
    out = {}
    for r in sorted(projection_forest.search(spark, vectors, every, k).collect()):
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert all([x[0] for x in v] == list(range(1, len(v) + 1)) for v in out.values())
    return {q: [(i, s) for _, i, s in v] for q, v in out.items()}


def test_recall_and_scores(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = table.orderBy("vec_id").collect()
    ids = np.array([r["vec_id"] for r in rows])
    vectors = np.array([r["embedding"] for r in rows], dtype=float)
    want, got = nearest(ids, vectors, 100, 10), found(spark, table, 100)
    assert got.keys() == want.keys() and all(len(v) == 10 for v in got.values())
    recall = [len({i for i, _ in want[q]} & {i for i, _ in got[q]}) / 10 for q in want]
    assert np.mean(recall) >= 0.9
    place = {int(i): k for k, i in enumerate(ids)}
    for q, near in got.items():
        assert near == sorted(near, key=lambda x: (x[1], x[0]))
        for i, score in near:
            exact = np.linalg.norm(vectors[place[q]] - vectors[place[i]])
            assert abs(score - exact) < 1e-12


def test_copies_and_ties_go_to_smaller_ids(spark):
    rows = [(i, [1.0, 0.0]) for i in range(0, 300)] + [(1000 + i, [0.0, float(i + 1)]) for i in range(5)]
    got = found(spark, spark.createDataFrame(rows, SCHEMA).repartition(4), 100, 3)
    assert [i for i, _ in got[0]] == [1, 2, 3] and [i for i, _ in got[100]] == [0, 1, 2]
    assert [i for i, _ in got[1000]] == [1001, 0, 1]


def test_small_leaves_blocks_and_few_rows(spark, monkeypatch):
    monkeypatch.setattr(projection_forest, "BLOCK_ROWS", 2)
    monkeypatch.setattr(projection_forest, "LEAF_SAMPLE", 5)
    rng = np.random.default_rng(2)
    data = rng.normal(size=(120, 4)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(data)]
    want = nearest(np.arange(120), data.astype(float), 7, 10)
    got = found(spark, spark.createDataFrame(rows, SCHEMA), 7)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}
    few = found(spark, spark.createDataFrame(rows[:3], SCHEMA), 2)
    assert {q: len(v) for q, v in few.items()} == {0: 2, 2: 2}


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (100, None), (200, []), (300, [0.0, 0.0]), (400, [nan, 1.0]), (500, [1.0, inf]),
        (600, [None, 1.0]), (700, [1.0, 2.0, 3.0]), (None, [1.0, 2.0]), (1, [1.0, 3.0]), (1, [1.0, 3.0]),
    ]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as v", "2 as rank", "3 as rep")
    assert found(spark, docs, 100) == {0: [(1, 1.0)]}


def test_empty_table(spark):
    got = projection_forest.search(spark, spark.createDataFrame([], SCHEMA), 100)
    assert got.columns == ["query_id", "rank", "vec_id", "score"] and got.count() == 0
