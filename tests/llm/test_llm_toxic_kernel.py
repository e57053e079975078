from __future__ import annotations

import zlib

import numpy as np
import pytest

from tillgrain.llm import toxic_kernel as op

WORDS = "the river runs along old stone walls while people walk slowly home after rain today".split()
BAD = ["grobnik", "flurzen", "tammerot"]
DOCS = "doc_id bigint, text string, lang string, source string"
LABELS = "doc_id bigint, quality int, toxic int"


def similarity(s: bytes, t: bytes) -> float:
    """K of two units, from all places of their subsequences."""

    def phi(u):
        out = {}
        for a in range(len(u)):
            for b in range(a + 1, len(u)):
                for c in range(b + 1, len(u)):
                    for d in range(c + 1, min(len(u), a + op.SPAN)):
                        key = (u[a], u[b], u[c], u[d])
                        out[key] = out.get(key, 0.0) + op.DECAY ** (d - a - 3)
        return out

    def norm(n):
        one = phi(range(n))
        return max(1.0, sum(v * v for v in one.values())) ** 0.5

    x, y = phi(s), phi(t)
    return sum(v * y.get(k, 0.0) for k, v in x.items()) / norm(len(s)) / norm(len(t))


def unit(text: str) -> bytes:
    (one,) = op.units_of([text.encode()]).strings()
    return one


def test_kernel_equals_its_definition():
    texts = ["idiot", "idxiot", "id-iot", "i d i o t", "hahahaha", "Éa", "strangely", "ß"]
    strings = [unit(t) for t in texts]
    units = op.from_strings(strings)
    got = op.kernel(units, units)
    want = np.array([[similarity(a, b) for b in strings] for a in strings])
    assert np.allclose(got, want, atol=1e-5)
    # The fitted weights give the machine's scores as sums over the landmarks.
    toxic = np.array([True] * 4 + [False] * 4)
    machine = op.fit(strings, toxic, np.ones(8))
    assert (machine.scores(units)[:4] > machine.scores(units)[4:].max()).all()


def test_units_of_sentences():
    units = op.units_of([b"You id-iot! a b c", b"", "xé\n\nlast".encode(), b"w" * 60])
    text = lambda s: "".join(" " if c == 0 else chr(c + 96) for c in s)
    got = [(int(t), text(s)) for t, s in zip(units.text, units.strings(), strict=True)]
    assert got[:3] == [(0, " you "), (0, " id iot "), (0, " a b c ")]
    assert got[3][0] == 2 and got[4] == (2, " last ")
    assert [t for t, _ in got[5:]] == [3] * len(got[5:])
    assert max(len(s) for _, s in got) == op.LONGEST + 2


def test_portions_keep_every_word():
    texts = [b"", b"alpha beta " * 50_000, b"gamma"]
    seen = {}
    for rows, lot in op.portions(iter(texts)):
        assert sum(map(len, lot)) <= 2 * op.PORTION
        for row, part in zip(rows, lot, strict=True):
            seen.setdefault(row, []).append(part)
    assert [b"".join(seen[i]) for i in range(3)] == texts
    assert all(p.endswith(b" ") for p in seen[1])


@pytest.fixture(scope="module")
def tables(spark):
    rng = np.random.default_rng(5)
    docs, labels = [], []
    for i in range(700):
        words = [str(w) for w in rng.choice(WORDS, 40)]
        toxic = i % 5 == 0
        if toxic:
            words[int(rng.integers(1, 39))] = BAD[i % 3]
        words[20] += "."
        docs.append((i, " ".join(words), "en", "web"))
        labels.append((i, 1, int(toxic)))
    docs += [
        (9001, "Such a g r o b n i k here", "en", "web"),
        (9002, "walls grobxnik stone", "en", "web"),
        (9003, "people flur-zen home", "en", "web"),
        (9004, None, "en", "web"),
        (9005, "", "en", "web"),
        (9006, "the river " * 40_000 + "tammerot", "en", "web"),
        (9007, "the river " * 40_000, "en", "web"),
        (None, "the old stone walls", None, None),
        (9008, "the old stone walls", "en", "web"),
        (9008, "the old stone walls", "en", "web"),
    ]
    labels += [(0, 1, 0), (1, None, None), (None, 1, 1), (55555, 1, 1), (2, 1, 7)]
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)


def test_held_out_accuracy_and_disguises(spark, tables):
    rows = op.report(spark, *tables).collect()
    assert len(rows) == 710
    by_id = {}
    for r in rows:
        by_id.setdefault(r["doc_id"], []).append(r)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        fold = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2
        assert r["held_out"] == fold
    held = [r for r in rows if r["held_out"] and r["doc_id"] < 700]
    assert sum(r["predicted"] == (r["doc_id"] % 5 == 0) for r in held) >= 0.97 * len(held)
    for disguised in (9001, 9002, 9003, 9006):
        assert by_id[disguised][0]["predicted"] == 1, disguised
    for clean in (9004, 9005, 9007, None, 9008):
        assert by_id[clean][0]["predicted"] == 0, clean
    assert len(by_id[9008]) == 2 and by_id[9004][0]["score"] == by_id[9005][0]["score"]


def test_without_labels_of_both_classes(spark, tables):
    docs = tables[0].where("doc_id < 20")
    none = spark.createDataFrame([], LABELS)
    assert {r["score"] for r in op.report(spark, docs, none).collect()} == {0.0}
    ones = spark.createDataFrame([(i, 1, 1) for i in range(20)], LABELS)
    assert {r["score"] for r in op.report(spark, docs, ones).collect()} == {1.0}
    empty = op.report(spark, docs.limit(0), tables[1])
    assert empty.collect() == []


def test_clashing_columns_are_ignored(spark, tables):
    docs = tables[0].where("doc_id < 50").selectExpr("*", "1 as toxic", "'x' as unit", "2 as score")
    got = op.report(spark, docs, tables[1])
    assert got.columns == ["doc_id", "held_out", "score", "predicted"] and got.count() == 50
