"""Duplicate flags and uniqueness of stored loads against one run over all their rows."""

from __future__ import annotations

from collections import Counter
from datetime import datetime

import pytest
from conftest import lines
from test_duplicates import HOT_KEYS, random_rows

from tillgrain.operators import quality
from tillgrain.operators.dedup import key_counts, mark_duplicates
from tillgrain.plans.key_store import KeyStore


def bag(df, *columns):
    return Counter(tuple(r) for r in df.select(*(columns or df.columns)).collect())


def same_as_one_run(store, raw):
    want = mark_duplicates(raw)
    assert bag(store.flags(), *want.columns) == bag(want)
    assert bag(store.counts()) == bag(key_counts(raw))
    assert bag(store.duplicate_groups()) == bag(quality.duplicate_groups(raw))
    got, one = store.uniqueness().first().asDict(), quality.uniqueness(raw).first().asDict()
    assert {k: v for k, v in got.items() if k in one and v != one[k] and "run" not in k} == {}


@pytest.mark.parametrize("hot", HOT_KEYS)
def test_loads_equal_one_run(spark, tmp_path, hot):
    store = KeyStore(spark, str(tmp_path), buckets=4)
    rows = random_rows(7, 400, hot)
    parts = [rows[:150], rows[150:160], [], rows[160:]]
    for k, part in enumerate(parts):
        store.add(lines(spark, part) if part else lines(spark, rows).limit(0))
        if k == 2:
            store.compact()
        same_as_one_run(store, lines(spark, [r for p in parts[: k + 1] for r in p]))


def test_an_earlier_row_in_a_later_load_takes_over(spark, tmp_path):
    key = {"invoice_no": "1", "stock_code": "A"}
    store = KeyStore(spark, str(tmp_path), buckets=2)
    for day in (5, 3, 4):
        store.add(lines(spark, [{**key, "invoice_date": datetime(2010, 1, day)}]))
    got = {r["invoice_date"].day: r["is_duplicate"] for r in store.flags().collect()}
    assert got == {3: 0, 4: 1, 5: 1}


def test_equal_rows_of_two_loads_keep_one(spark, tmp_path):
    store = KeyStore(spark, str(tmp_path), buckets=2)
    for _ in range(3):
        store.add(lines(spark, [{"invoice_no": "1", "stock_code": None}] * 2))
    assert bag(store.flags(), "is_duplicate") == {(0,): 1, (1,): 5}


def test_a_load_reads_keys_alone_and_does_not_shuffle_them(spark, tmp_path, capsys):
    store = KeyStore(spark, str(tmp_path), buckets=4)
    first = random_rows(1, 50, HOT_KEYS[0])
    store.add(lines(spark, first))
    commit = store.staged(lines(spark, random_rows(2, 50, HOT_KEYS[0])))
    overruled = store.overruled_by(commit)
    assert overruled.count() > 0
    assert all("/data/keys/" in f for f in overruled.inputFiles())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for frame in (store.overruled_by(commit), store.counts()):
            frame.explain()
            plan = capsys.readouterr().out
            assert "Scan parquet" in plan and "Exchange" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Nothing shows before the version is published.
    same_as_one_run(store, lines(spark, first))


def test_a_store_keeps_its_buckets(spark, tmp_path):
    KeyStore(spark, str(tmp_path), buckets=2).add(lines(spark, [{}]))
    store = KeyStore(spark, str(tmp_path), buckets=8)
    store.add(lines(spark, [{}]))
    assert len(store.latest().read("keys").inputFiles()) <= 2 * 2
    assert store.counts().first()["occurrence_count"] == 2


def test_reading_before_the_first_load(spark, tmp_path):
    with pytest.raises(ValueError, match="no load"):
        KeyStore(spark, str(tmp_path)).flags()
