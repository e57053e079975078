"""What checks and invariants write and deal: nothing that one reader could compute as it goes."""

from __future__ import annotations

from collections import Counter
from datetime import datetime

import pytest
from conftest import SMALL, lines

from tillgrain.operators import checks, dedup, quality, staging
from tillgrain.plans import catalog
from tillgrain.sources import tables
from tillgrain.sources.star_adapter import STAR_RULES


@pytest.fixture()
def written(monkeypatch):
    labels, write = [], tables.materialise

    def noted(spark, df, label, partition_by=None):
        labels.append(label)
        return write(spark, df, label, partition_by)

    monkeypatch.setattr(tables, "_STORED", {})
    monkeypatch.setattr(tables, "materialise", noted)
    return labels


def key_rows(spark):
    rows = [{"invoice_no": f"{i}", "quantity": float(i)} for i in range(9)]
    rows += [{"invoice_no": " 3 ", "invoice_date": datetime(2011, 1, 1)}, {"invoice_no": "4"}]
    rows += [{"invoice_no": None}, {"invoice_no": None, "stock_code": None}] * 2
    return lines(spark, rows + [{"invoice_no": "", "stock_code": " "}])


def test_value_lists_of_a_table_share_one_scan(spark):
    t = spark.createDataFrame(
        [(1, 1.5), (1, None), (None, 2.5), (2, 1.5), (3, 2.5)], "k INT, x DOUBLE"
    )
    found = [
        checks.accepted_values("t", "k", [2]),
        checks.accepted_values("t", "x", [9.0]),
        checks.accepted_values("t", "k", [1, 2, 3], severity="warn"),
    ]
    counted = checks.results(found, {"t": t})
    assert "Union" not in counted._jdf.queryExecution().optimizedPlan().toString()
    assert [r.failing_rows for r in counted.collect()] == [2, 2, 0]


@pytest.mark.parametrize("most", [dedup.REPEATED_KEYS, 1])
def test_lines_by_key_give_the_same_tables(spark, most):
    raw = key_rows(spark)
    rows = dedup.by_key(raw, most)
    assert rows.once is None if most == 1 else rows.rest.count() == 8
    staged = lambda df: staging.stage(df, STAR_RULES)
    want = dedup.keep_latest(staged(raw))
    found = dedup.keep_latest_by_key(rows, staged)
    assert found.columns == want.columns
    assert Counter(map(tuple, found.collect())) == Counter(map(tuple, want.collect()))
    assert quality.uniqueness_by_key(rows).collect() == quality.uniqueness_counts(raw).collect()


def test_value_lists_store_no_lines_but_the_raw_ones(spark, written):
    catalog.queries()["check_accepted_values"](spark, SMALL)
    assert "txn_deduplicated" not in written
    house = catalog.stored_tables(spark, SMALL)
    assert house.dq_row_level_flags.columns == list(catalog.FLAG_COLUMNS)


def test_counted_tables_are_not_stored(spark, written):
    catalog.queries()["check_equal_rowcount"](spark, SMALL)
    assert set(written) == {"raw", "txn_deduplicated", "dq_completeness"}


def test_deduplicated_lines_are_not_dealt_as_a_whole(spark):
    house = catalog.lakehouse(spark, SMALL)
    assert house.by_key.rest.count() < house.raw.count() / 10
    # The lines of single keys reach the result without an exchange by key.
    plan = house.txn_deduplicated._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and plan.split("Union")[1].split("Window")[0].count("Aggregate") == 0
