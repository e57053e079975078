from __future__ import annotations

import random

import corpus_pipeline
import pytest
from pyspark.sql import DataFrame

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def stages(spark):
    """Documents of the small table and planted ones, after every stage."""
    base = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rng = random.Random(3)
    words = [w for r in base.where("lang = 'en'").limit(200).collect() for w in r["text"].split()]

    def prose(n):
        return " ".join(rng.choice(words) for _ in range(n)) + "."

    original, passage = prose(300), prose(70)
    planted = {
        10_000: original,
        10_001: original,
        10_002: original.replace(original.split()[150], "changed", 1),
        10_003: f"{prose(40)}\n{passage}\n{prose(40)}",
        10_004: f"{prose(40)}\n{passage}\n{prose(40)}",
        10_005: f"{prose(60)} password = 0123456789abcdef0123 {prose(20)}",
        10_006: "12345 67890",
        10_007: prose(80),
    }
    rows = [(i, t, None, "planted", len(t)) for i, t in planted.items()]
    docs = base.union(spark.createDataFrame(rows, SCHEMA))
    after: dict[str, DataFrame] = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialise(spark, stage(spark, docs, ""), name)
        after[name] = docs
    return planted, passage, after


def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.where("doc_id >= 10000").collect()}


def test_columns(stages):
    _, _, after = stages
    for name in ("language", "near_duplicates", "repeated_passages", "secrets"):
        assert after[name].columns == after["documents"].columns


def test_decisions_take_effect(stages):
    planted, passage, after = stages
    assert set(texts(after["language"])) == set(planted) - {10_006}
    unique = texts(after["near_duplicates"])
    assert set(unique) == set(planted) - {10_001, 10_002, 10_006}
    cut = texts(after["repeated_passages"])
    assert passage in cut[10_003] and passage not in cut[10_004]
    assert cut[10_007] == planted[10_007]
    hidden = texts(after["secrets"])
    assert "0123456789abcdef0123" not in hidden[10_005] and "[secret]" in hidden[10_005]
    assert hidden[10_007] == planted[10_007]
    packed = {r["doc_id"] for r in after["packed"].collect()}
    assert packed == {r["doc_id"] for r in after["secrets"].select("doc_id").collect()}


def test_language_keeps_all_labelled_documents(stages):
    _, _, after = stages
    assert after["language"].where("doc_id < 10000").count() == 1000


def test_run_over_the_smallest_table(spark):
    got = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert got.count() > 0 and "sequence_id" in got.columns


def test_stages_on_an_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
    assert docs.count() == 0
