from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from tillgrain.llm import code_trie

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute_force(rows):
    """Row by row, entry by entry."""
    kept = [
        (i, [math.floor(1024 * float(np.float32(x))) for x in v], label)
        for i, v, label in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    longest = max((len(v) for _, v, _ in kept), default=0)
    width = -(-longest // 4)
    kept = [(i, v + [0] * (4 * width - len(v)), label) for i, v, label in kept]
    part = lambda v, p: v[p * width : (p + 1) * width]
    books = [[part(v, p) for _, v, _ in kept[:256]] for p in range(4)]

    def assign(x, book):
        far = [sum((a - b) ** 2 for a, b in zip(x, e, strict=True)) for e in book]
        return far.index(min(far)), min(far)

    for _ in range(4):
        for p in range(4):
            members = [[] for _ in books[p]]
            for _, v, _ in kept:
                members[assign(part(v, p), books[p])[0]].append(part(v, p))
            books[p] = [
                [sum(c) // len(m) for c in zip(*m, strict=True)] if m else e
                for m, e in zip(members, books[p], strict=True)
            ]
    out, by_label = [], {}
    for i, v, label in kept:
        hits = [assign(part(v, p), books[p]) for p in range(4)]
        error = sum(e for _, e in hits)
        out.append((i, "".join(f"{c:02x}" for c, _ in hits), error, label))
        by_label[label] = by_label.get(label, 0) + error
    flat = ",".join(str(x) for b in books for e in b for x in e)
    sha = hashlib.sha256(flat.encode()).hexdigest()
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    return sorted([(i, c, e, by_label[label], sha) for i, c, e, label in out], key=key)


def compressed(spark, rows, schema=SCHEMA):
    got = code_trie.compress(spark, spark.createDataFrame(rows, schema))
    return sorted([tuple(r) for r in got.collect()], key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(code_trie, "LEAVES", 8)
    rng = np.random.default_rng(3)
    rows = [
        (i, [float(x) for x in rng.normal(0, 0.01, 8).astype(np.float32)], int(i % 3) or None)
        for i in range(400)
    ]
    # A third of the rows hold one vector, and vectors share prefixes.
    rows += [(1000 + i, rows[0][1], 5) for i in range(150)]
    rows += [(2000 + i, rows[i][1][:5] + [0.5, 0.25, -0.5], 1) for i in range(50)]
    assert compressed(spark, rows) == brute_force(rows)


def test_heavy_labels_give_the_same(spark, monkeypatch):
    rows = [(i, [0.1 * i, 0.2, -0.3 * i, 0.4], i % 4) for i in range(30)]
    want = brute_force(rows)
    monkeypatch.setattr(code_trie, "HEAVY_LABEL", 7)
    assert compressed(spark, rows) == want


def test_nulls_lengths_and_repeated_ids(spark):
    rows = [
        (5, None, 1),
        (6, [0.1, None, 0.2, 0.3], 1),
        (7, [0.1, float("nan"), 0.2, 0.3], None),
        (8, [float("inf"), 0.0, 0.0, 0.0], 2),
        (None, [0.5, 0.5, -0.5, -0.001, 0.25], None),
        (2, [0.1, 0.2, 0.3], None),
        (2, [0.1, 0.2, 0.3], 4),
        (2, [0.3, 0.2, 0.1, 0.7], 4),
        (9, [], 4),
    ]
    assert compressed(spark, rows) == brute_force(rows)


def test_ties_go_to_the_lower_entry():
    entries = np.array([[2, 0], [0, 0], [2, 0], [4, 0]])
    parts = np.array([[1, 0], [2, 0], [3, 0]])
    code, error = code_trie.nearest(parts, entries)
    assert code.tolist() == [0, 0, 0] and error.tolist() == [1, 0, 1]


def test_large_components_do_not_overflow(spark):
    rows = [(1, [3e38, 0.0, 1.0, -3e38], 1), (2, [-3e38, 0.0, 1.0, 3e38], 1)]
    got = compressed(spark, rows)
    assert [r[2] for r in got] == [0, 0]


@pytest.mark.parametrize("width", [1, 3, 16])
def test_trie_walk_equals_plain_distances(width, monkeypatch):
    monkeypatch.setattr(code_trie, "LEAVES", 16)
    rng = np.random.default_rng(width)
    parts, which = code_trie._trie_order(rng.integers(-3, 3, (900, width)))
    assert which.size == 900
    entries = rng.integers(-3, 3, (40, width))
    code, error = code_trie.nearest(parts, entries)
    plain = ((parts[:, None, :] - entries[None]) ** 2).sum(axis=2)
    assert (code == plain.argmin(axis=1)).all() and (error == plain.min(axis=1)).all()


def test_empty_table_and_clashing_columns(spark):
    assert compressed(spark, []) == []
    more = SCHEMA + ", v string, code string, error string, n int"
    rows = [(1, [1.0, 2.0, 3.0, 4.0], 1, "a", "b", "c", 4)]
    assert compressed(spark, rows, more) == brute_force([r[:3] for r in rows])
