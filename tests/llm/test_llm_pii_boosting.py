from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillgrain.llm import boosted_trees, pii_boosting

SCHEMA = "doc_id bigint, text string"


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def digits(m):
    return re.sub("[^0-9]", "", m[0])


KINDS = [
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), lambda m: True),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), lambda m: all(int(x) <= 255 for x in m[0].split("."))),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+"), lambda m: 14 <= len(digits(m)) <= 19 and luhn(digits(m))),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), lambda m: 10 <= len(digits(m)) <= 15),
]
ODD = [
    None, "", "a@b.c@d.e x@y.z%q@w.v", "éé a.b@c-d.e.f. 1.2.3.4.5.6.7.8 256.1.1.1 001.2.3.4",
    "4111 1111 1111 1111 4111-1111-1111-1111 5500000000000004", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5",
    "+1 (743) 555-3824 (743) 555-3824 +12345678901234567", "\x01a@b\x01c.d \x02 1\x011",
    "..a..b@..c.d a@b..c a@-.- ", "1 2 " * 9000, "a@b.co " * 3000, "9" * 30_000, "a" * 30_000 + "@",
    "é" * 200 + "x@y.zz " + "ü 10.0.0.1\n" * 300, "1-2 3--4 5" * 50,
]


def base(text):
    spans = sorted(
        (m.start(), i, kind, m.end())
        for i, (kind, pattern, fits) in enumerate(KINDS)
        for m in pattern.finditer(text)
        if fits(m)
    )
    return [f"{kind}:{a}:{b}" for a, _, kind, b in spans]


def test_base_spans_match_the_patterns(spark):
    rng = random.Random(5)
    small = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    texts = ODD + [r["text"] for r in small]
    texts += ["".join(rng.choice("ab1234567890.@-+ ()%é\n") for _ in range(rng.randrange(200))) for _ in range(300)]
    rows = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    got = pii_boosting.report(pii_boosting.find(rows, pii_boosting.learn(rows))).collect()
    assert len(got) == len(texts)
    for r in got:
        want = base(texts[r["doc_id"]] or "")
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest(), r["doc_id"]
        for kind, _, _ in KINDS:
            assert r[f"n_{kind}"] == sum(s.startswith(kind + ":") for s in want)
        every = r["spans"].split(",") if r["spans"] else []
        assert set(want) <= set(every)
        # What was added touches no base span.
        bounds = [tuple(map(int, s.split(":")[1:])) for s in want]
        for s in set(every) - set(want):
            a, b = map(int, s.split(":")[1:])
            assert not any(x < b and a < y for x, y in bounds)


def test_trees_fit_and_score_alike_in_sql(spark):
    rng = np.random.default_rng(4)
    x = rng.integers(0, 10, size=(800, 3))
    y = ((x[:, 0] > 4) & (x[:, 2] < 7)).astype(float)
    trees = boosted_trees.fit(x, y)
    odds = boosted_trees.log_odds(trees, x)
    assert ((odds > 0) == (y > 0)).mean() > 0.99
    rows = spark.createDataFrame([(r.tolist(),) for r in x[:100]], "x array<int>")
    score = boosted_trees.expression(trees, lambda i: F.get("x", F.lit(i)))
    got = [r["s"] for r in rows.select(score.alias("s")).collect()]
    assert got == pytest.approx(odds[:100].tolist())
    assert boosted_trees.fit(x[:0], y[:0]) == []


def test_threshold_keeps_the_precision():
    odds = np.linspace(5, -5, 100)
    y = (np.arange(100) < 40).astype(float)
    least = pii_boosting._threshold(odds, y)
    picked = odds >= least
    assert y[picked].mean() >= pii_boosting.PRECISION and picked.sum() >= 40
    assert pii_boosting._threshold(odds, np.zeros(100)) is None
    assert pii_boosting._threshold(odds[:0], y[:0]) is None


def _card(rng, digits):
    """A number with a card's first digit and check digit."""
    body = [4] + [rng.randrange(10) for _ in range(digits - 2)]
    twice = [d if i % 2 else 2 * d - 9 * (d > 4) for i, d in enumerate(reversed(body))]
    return "".join(map(str, body)) + str(-sum(twice) % 10)


def _mixed(n):
    """Base forms, wider forms and clean texts."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdeilnorst") for _ in range(rng.randrange(3, 9)))
    wide, clean = [], []
    for _ in range(n):
        number = f"({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"
        card = _card(rng, 16)
        at, dot = rng.choice([(" at ", " dot "), (" [at] ", " [dot] "), ("(at)", "(dot)")])
        wide += [
            f"{word()} call +1 {number} now", f"{word()} phone {number} {word()}",
            f"write {word()}@{word()}.com {word()}", f"{word()} {word()}.{word()}{at}{word()}{dot}org {word()}",
            f"card {card} {word()}", f"{word()} {'.'.join(card[i:i + 4] for i in range(0, 16, 4))} {word()}",
        ]
        clean += [
            f"build {rng.randrange(10**9, 10**10)} of {rng.randrange(1900, 2030)}-10-11 10.20",
            f"{word()} {word()} at {word()}. {word().title()} {word()} dot {word()}",
            f"{word()} {rng.randrange(10**12, 10**13)} {word()}",
        ]
    return wide, clean


def test_wider_forms_are_found_and_clean_texts_left_alone(spark):
    wide, clean = _mixed(150)
    model = pii_boosting.learn(spark.createDataFrame(list(enumerate(wide + clean)), SCHEMA))
    forms = {
        "phone (743) 555-3824 there": "phone:6:20",
        "ask jane.doe at example dot org today": "email:4:31",
        "ask bob [at] corp [dot] org": "email:4:27",
        "paid 4111.1111.1111.1111 then": "card:5:24",
        "build 1234567890 of 2001-10-11": "",
    }
    _, others = _mixed(200)
    others = [t for t in others[450:] if not base(t)]
    docs = spark.createDataFrame(list(enumerate([*forms, *others])), SCHEMA)
    got = {r["doc_id"]: r["spans"] for r in pii_boosting.report(pii_boosting.find(docs, model)).collect()}
    assert [got[i] for i in range(len(forms))] == list(forms.values())
    assert {i: got[i] for i in range(len(forms), len(got)) if got[i]} == {}


def test_the_sample_is_that_of_the_smallest_hashes(spark):
    rows = spark.range(500).select(
        F.xxhash64("id").alias("h"), F.array(F.col("id").cast("int")).alias("x"), F.lit(1).alias("y")
    )
    want = sorted(tuple(r) for r in rows.collect())[:40]
    assert [tuple(r) for r in pii_boosting._sampled(rows, 40)] == want


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "a@b.cd")], SCHEMA)
    found = pii_boosting.find(docs, pii_boosting.learn(docs))
    plan = pii_boosting.report(found)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (None, "a@b.cd"), (3, "x"), (3, "x")]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as t", "2 as spans", "3 as _base")
    got = pii_boosting.report(pii_boosting.find(docs, pii_boosting.learn(docs))).collect()
    assert sorted((str(r["doc_id"]), r["spans"]) for r in got) == [
        ("1", ""), ("2", ""), ("3", ""), ("3", ""), ("None", "email:0:6"),
    ]
    empty = spark.createDataFrame([], SCHEMA)
    assert pii_boosting.report(pii_boosting.find(empty, pii_boosting.learn(empty))).count() == 0


def test_every_candidate_counts_in_learning(spark, monkeypatch):
    """More candidates than a sample took, equal ones as one weighted row."""
    seen, fit = [], boosted_trees.fit
    def noted(x, y, weight):  # noqa: E306
        seen.append((len(y), weight.sum()))
        return fit(x, y, weight=weight)
    monkeypatch.setattr(boosted_trees, "fit", noted)  # noqa: E305
    docs = spark.range(60_000).selectExpr("id AS doc_id", "concat('host 10.0.0.', id % 10, ' up') AS text")
    model = pii_boosting.learn(docs)
    rows, weight = seen[0]
    assert rows < 20 and 25_000 < weight < 35_000 and model.thresholds[1] is not None


def test_weights_stand_for_equal_rows():
    rng = np.random.default_rng(7)
    x, n = rng.integers(0, 6, size=(60, 3)), rng.integers(1, 9, size=60)
    y = (x[:, 0] > x[:, 1]).astype(float)
    odds = boosted_trees.log_odds(boosted_trees.fit(x, y, weight=n), x)
    copies = boosted_trees.fit(np.repeat(x, n, axis=0), np.repeat(y, n))
    assert odds == pytest.approx(boosted_trees.log_odds(copies, x))
    least = pii_boosting._threshold(odds, y, n)
    assert least == pii_boosting._threshold(np.repeat(odds, n), np.repeat(y, n))
