from __future__ import annotations

from zlib import crc32

import numpy as np

from tillgrain.llm import language_profiles
from tillgrain.llm.language_profiles import ngrams, ranking

SCHEMA = "doc_id bigint, text string, lang string"


def test_ngrams_of_words_with_blanks_at_both_ends():
    grams, counts = ngrams("Ab, ab 1")
    a, b, blank = ord("a"), ord("b"), 32
    want = {
        a: 2, b: 2, blank << 21 | a: 2, a << 21 | b: 2, b << 21 | blank: 2,
        (blank << 21 | a) << 21 | b: 2, (a << 21 | b) << 21 | blank: 2,
    }
    assert dict(zip(grams.tolist(), counts.tolist(), strict=True)) == want
    assert ngrams("12 .")[0].size == 0 and ngrams("")[0].size == 0


def test_ranking_breaks_ties_by_code_points():
    grams, counts = np.arange(5000), np.ones(5000, dtype=int)
    counts[[4000, 7]] = 5
    assert ranking(grams, counts, 4).tolist() == [7, 4000, 0, 1]


def test_held_out_accuracy_and_contract(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_profiles.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == docs.count()
    assert all(r["held_out"] == (crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    assert all(0 <= r["score"] <= 1 for r in got)
    judged = [r for r in got if r["held_out"] and r["lang"]]
    assert sum(r["lang"] == r["lang_pred"] for r in judged) >= 0.98 * len(judged) > 100


def test_out_of_place_distance_by_hand(spark):
    # Each text has one word, so its ranks follow code points.
    profiles = {"x": ranking(*ngrams("ab"), 400), "y": ranking(*ngrams("cd"), 400)}
    docs = spark.createDataFrame([(1, "ab", None), (2, "cd", None), (3, "zz", None)], SCHEMA)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_profiles.predict(docs, profiles).collect()}
    assert got[1] == ("x", 1.0) and got[2] == ("y", 1.0)
    assert got[3] == ("x", 0.0)


def test_edge_rows(spark):
    rows = [(1, None, "en"), (2, "", None), (3, "12 !", "de"), (None, "der und die", None),
            (4, "x " * 100_000, "en"), (5, "the cat", "en"), (5, "the cat", "en")]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'q' as score", "1 as lang_pred", "2 as n")
    got = language_profiles.identify(docs)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    by_id = {}
    for r in got.collect():
        by_id.setdefault(r["doc_id"], []).append(r)
    for i in (1, 2, 3):
        assert (by_id[i][0]["lang_pred"], by_id[i][0]["score"]) == ("und", 0.0)
    assert len(by_id[5]) == 2 and len(by_id[None]) == 1


def test_without_labels_and_without_rows(spark):
    docs = spark.createDataFrame([(1, "some text", None)], SCHEMA)
    assert language_profiles.identify(docs).first()["lang_pred"] == "und"
    assert language_profiles.identify(spark.createDataFrame([], SCHEMA)).count() == 0
