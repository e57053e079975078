"""What queries deal and store, and how often: figures that must not grow beyond the input."""

from __future__ import annotations

from collections import Counter

import pytest
from conftest import SMALL, lines

from tillgrain.operators import dedup, rowflags
from tillgrain.plans import catalog
from tillgrain.rules import RAW_COLUMNS
from tillgrain.sources import tables
from tillgrain.sources.star_adapter import STAR_RULES, raw_lines


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def written(monkeypatch):
    """Labels of the tables written, in a fresh memory of stored tables."""
    labels, write = [], tables.materialise

    def noted(spark, df, label, partition_by=None):
        labels.append(label)
        return write(spark, df, label, partition_by)

    monkeypatch.setattr(tables, "_STORED", {})
    monkeypatch.setattr(tables, "materialise", noted)
    return labels


def test_orders_meet_customers_before_the_lines(spark):
    joins = raw_lines(spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    on = [line.split("Inner,")[1] for line in joins.splitlines() if "Join Inner" in line]
    assert ["l_partkey" in on[0], "l_orderkey" in on[1], "o_custkey" in on[2]] == [True] * 3


def test_checked_tables_read_what_is_stored(spark, written):
    house = catalog.stored_tables(spark, SMALL)
    for name in ("txn_enriched", "txn_filtered"):
        assert "Window" not in plan(house[name]) and "Exchange" not in plan(house[name])
    house.composite_grain, house.dq_summary, house.dq_uniqueness
    assert Counter(written) == dict.fromkeys(
        (
            "raw", "txn_deduplicated", "customer_activity_months", "composite_grain",
            "uniqueness_counts", "dq_summary", "dq_uniqueness",
        ),
        1,
    )


def test_incremental_queries_store_what_they_read(spark, written):
    catalog.queries()["grain_incremental_affected"](spark, SMALL)
    assert written == ["raw", "txn_deduplicated", "moved_grain"]
    catalog.queries()["rfm_incremental_affected"](spark, SMALL)
    assert written[3:] == ["moved_monthly", "moved_rfm"]
    catalog.queries()["rfm_incremental"](spark, SMALL)
    assert written[5:] == ["totals_by_month", "earlier_rfm", "earlier_balances"]


def test_rows_of_single_keys_are_not_dealt(spark, monkeypatch):
    rows = [{"invoice_no": f"{i % 40}", "quantity": float(i)} for i in range(60)]
    rows += [{"invoice_no": None, "stock_code": None}] * 3 + [{"invoice_no": ""}]
    raw = lines(spark, rows)
    want = Counter(tuple(r) for r in dedup.mark_duplicates(raw).collect())
    for most in (dedup.REPEATED_KEYS, 3):
        marked = dedup.mark_repeated(raw, most)
        assert marked.columns == [*RAW_COLUMNS, "is_duplicate"]
        assert Counter(tuple(r) for r in marked.collect()) == want
    ranked, rank = [], dedup.mark_duplicates
    monkeypatch.setattr(dedup, "mark_duplicates", lambda rows: ranked.append(rows.count()) or rank(rows))
    flagged = rowflags.flag_rows(spark, raw, STAR_RULES)
    assert flagged.where("is_duplicate = 1").count() == sum(n for r, n in want.items() if r[-1])
    # Twenty keys twice, one three times.
    assert ranked == [43]


def test_buckets_of_keys_grow_with_the_lines(spark, monkeypatch):
    monkeypatch.setattr(catalog, "_STORES", {})
    monkeypatch.setattr(catalog, "LINES_PER_BUCKET", 500)
    store, at = catalog._second_load(spark, SMALL)
    n = catalog.lakehouse(spark, SMALL).raw.count()
    assert store._buckets(at).number == n // 500 > catalog.STAR_BUCKETS


def test_one_folder_is_written_without_a_shuffle(spark, tmp_path):
    from tillgrain.sources.versions import VersionedStore

    commit = VersionedStore(spark, str(tmp_path)).begin(None)
    rows = spark.range(0, 8, 1, 4).selectExpr("id", "1 AS load")
    read = commit.write("t", rows, "load", ["1"])
    # As they lie: one file for each of the four splits.
    assert len(read.inputFiles()) == 4 and read.count() == 8


def test_the_grain_is_written_as_the_facts_lie(spark, tmp_path, monkeypatch):
    from pyspark.sql import DataFrame

    from tillgrain.operators import staging
    from tillgrain.plans.stored_state import StateStore

    dealt, hint = [], DataFrame.hint
    monkeypatch.setattr(DataFrame, "hint", lambda df, *a: dealt.append(df.columns) or hint(df, *a))
    house = catalog.stored_tables(spark, SMALL)
    clean = staging.enrich(house.txn_deduplicated).drop("rn")
    at = StateStore(spark, str(tmp_path), STAR_RULES).start(clean)
    assert at.read("composite_grain").columns not in dealt
    assert at.read("composite_grain").exceptAll(house.composite_grain).count() == 0
    assert at.read("composite_grain").count() == house.composite_grain.count()
