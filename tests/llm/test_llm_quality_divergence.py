from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillgrain.llm import quality_divergence as quality

SCHEMA = "doc_id bigint, text string, lang string"
WORD = re.compile(r"[^\x20\x09-\x0d]+")


def measures(text):
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    return (
        len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)), len(covered),
        len(words) < 50 or 100 * len(covered) > 50 * len(words),
    )


def test_base_measures_match_brute_force(spark):
    rng = random.Random(8)
    texts = [
        "", " ", "a", "a b", "a b c", "a b c a b c", "a a a a a", "x\n\n x\nx\n \nx\r\n", "é\x85b\xa0c #*$",
        "one two three " * 30, "\x0b\x0cq\x1cz", "w " * 40_000, "line\n" * 5000,
    ]
    texts += ["".join(rng.choice("ab \n#|") for _ in range(rng.randrange(300))) for _ in range(150)]
    small = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    texts += [r["text"] for r in small]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], SCHEMA)
    shown = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    for r in quality.base_rules(docs).select("doc_id", *shown).collect():
        assert tuple(r)[1:] == measures(texts[r["doc_id"]])


def test_classes_are_counted_without_the_frequent_characters(spark):
    texts = ["", "plain words\nonly", "ÄÖ äö Aé9,.#\t\r\x0b\x1c \U0001f600\U0001d400", "A" * 5000, "a b\n" * 5000]
    docs = spark.createDataFrame([(t,) for t in texts], "t string")
    each = [F.regexp_count("t", F.lit(c)).cast("bigint") for c in quality.CLASSES.values()]
    got = docs.select(quality._class_counts(F.col("t")).alias("c"), F.array(*each).alias("each"), F.length("t"))
    for r in got.collect():
        assert r["c"] == [*r["each"], r[2]]
    # One pass takes them out; the passes per class read the rest.
    assert "regexp_replace(t" in got._jdf.queryExecution().optimizedPlan().toString()


def test_sought_words_are_counted_in_one_pass(spark):
    rng = random.Random(10)
    sought = sorted(["a", "aa", "b", "the", "The", "é", "zz", "\U0001f600", "\uffee"])
    some = [*sought, "ab", "th", "z", "e", "zzz"]
    texts = [[], ["ab"], ["zz"], ["a"] * 30_000, [*sought], ["zzz", "\U0001f600", "\U0001f600"]]
    texts += [[rng.choice(some) for _ in range(rng.randrange(80))] for _ in range(60)]
    rows = spark.createDataFrame([(t,) for t in texts], "w array<string>")
    for few in (sought, ["the"], []):
        for r in rows.select("w", quality.counts_of(F.col("w"), few).alias("n")).collect():
            assert r["n"] == [r["w"].count(x) for x in few]
    # The judgement uses it: no pass over the common words of a text for each of them.
    docs = spark.createDataFrame([(1, "the cat sat", "en"), (2, "le chat", "fr")], SCHEMA)
    plan = quality.judge(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "array_remove(lambda" not in plan and "sort_array(concat(filter(words" in plan


def test_repeated_words_follow_the_windows_in_order(spark):
    rng = random.Random(11)
    texts = [" ".join(rng.choice("abcd"[: rng.randrange(1, 5)]) for _ in range(n)) for n in range(120)]
    texts += [f"{'x y z ' * k}{' '.join(f'w{i}' for i in range(n))} x y z x" for k in (0, 1, 2) for n in (0, 1, 2, 9)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], SCHEMA)
    based = quality.base_rules(docs)
    for r in based.collect():
        assert r["n_repeat_words"] == measures(texts[r["doc_id"]])[4]
    # Windows are sorted as numbers, not as structs with their places.
    assert "sort_array(transform(_w" not in based._jdf.queryExecution().optimizedPlan().toString()


def test_jensen_shannon_matches_numpy(spark):
    rng = np.random.default_rng(9)
    q = rng.dirichlet(np.ones(6))
    q[2] = 0.0
    counts = rng.integers(0, 9, size=(20, 6))
    rows = spark.createDataFrame([(c.tolist(),) for c in counts], "c array<bigint>")
    total = F.aggregate("c", F.lit(0).cast("bigint"), lambda a, x: a + x)
    got = rows.withColumn("s", total).select(
        "c", quality.jensen_shannon(F.col("c"), F.col("s"), F.array(*map(F.lit, q.tolist()))).alias("d")
    )
    for r in got.collect():
        p = np.array(r["c"]) / sum(r["c"])
        m = (p + q) / 2
        with np.errstate(divide="ignore", invalid="ignore"):
            parts = [np.nansum(np.where(x > 0, x * np.log2(x / m), 0)) for x in (p, q)]
        assert r["d"] == pytest.approx(np.sqrt(sum(parts) / 2))


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "the cat sat", "en")], SCHEMA)
    plan = quality.judge(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_verdict_on_the_small_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = quality.judge(docs).join(labels, "doc_id").where("not base_failed").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1]
    poor = [r["kept"] for r in rows if r["quality"] == 0]
    assert sum(good) >= 0.99 * len(good) > 100
    assert sum(poor) <= 0.4 * len(poor)


def test_edge_rows(spark):
    text = " ".join(f"word{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60))
    rows = [(1, None, "en"), (2, "", None), (None, text, "en"), (3, text, None), (3, text, None)]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as t", "2 as words", "3 as kept", "4 as _c")
    got = quality.judge(docs)
    by_id = {}
    for r in got.collect():
        by_id.setdefault(r["doc_id"], []).append(r)
    for i in (1, 2):
        assert by_id[i][0]["n_words"] == 0 and by_id[i][0]["base_failed"] and not by_id[i][0]["kept"]
    assert len(by_id[3]) == 2 and by_id[3][0]["kept"] and by_id[None][0]["kept"]


def test_without_labels_and_without_rows(spark):
    docs = spark.createDataFrame([(1, "a b c " * 5, None)], SCHEMA)
    assert quality.judge(docs).first()["base_failed"]
    assert quality.judge(spark.createDataFrame([], SCHEMA)).count() == 0
