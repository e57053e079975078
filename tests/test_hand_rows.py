"""Hand-made rows with known flags."""

from __future__ import annotations

from datetime import datetime

import pytest
from conftest import RULES, lines

from tillgrain.operators import quality, rowflags, staging, usable
from tillgrain.operators.dedup import keep_latest

# (name, what differs from a clean line, raised flags, staged country flag, kept)
HAND_ROWS = [
    ("h01", dict(invoice_no="536365", stock_code="85123A", quantity=6.0, unit_price=2.55),
     [], 0, True),
    ("h02", dict(invoice_no="536365", stock_code="85123A", quantity=2.0, unit_price=2.55,
                 invoice_date=datetime(2010, 12, 1, 9, 0)), ["is_duplicate"], 0, True),
    ("h03", dict(invoice_no="C536379", stock_code="D", quantity=-1.0, unit_price=27.5),
     [], 0, True),
    ("h04", dict(invoice_no="A563185", stock_code="B", unit_price=-11062.06, customer_id=None),
     ["invalid_invoice_no", "invalid_unit_price", "inconsistent_sales_price"], 0, False),
    ("h05", dict(description=None, quantity=56.0, unit_price=0.0),
     ["incomplete_description", "invalid_description", "inconsistent_sales_price"], 0, True),
    ("h06", dict(country=" France"), ["invalid_country"], 0, True),
    ("h07", dict(country=None), ["incomplete_country"], 0, True),
    ("h08", dict(country=""), ["incomplete_country", "invalid_country"], 1, True),
    ("h09", dict(country="France\n"), ["invalid_country"], 1, True),
    ("h10", dict(description="???"), ["invalid_description"], 0, True),
    ("h11", dict(description="---"), [], 0, True),
    ("h12", dict(description="aaAAa x"), ["invalid_description"], 0, True),
    ("h13", dict(quantity=10001.0), ["invalid_quantity"], 0, True),
    ("h14", dict(quantity=0.0), ["invalid_quantity"], 0, True),
    ("h15", dict(quantity=None), ["incomplete_quantity", "invalid_quantity"], 0, True),
    ("h16", dict(unit_price=2.555), ["invalid_unit_price"], 0, True),
    ("h17", dict(unit_price=0.1 + 0.2), [], 0, True),
    ("h18", dict(unit_price=100000.0), ["invalid_unit_price"], 0, True),
    ("h19", dict(invoice_date=datetime(2999, 1, 1)), ["invalid_invoice_date"], 0, True),
    ("h20", dict(invoice_date=None), ["incomplete_invoice_date", "invalid_invoice_date"],
     0, True),
    ("h21", dict(invoice_no=None, stock_code=None),
     ["incomplete_invoice_no", "incomplete_stock_code", "invalid_invoice_no",
      "invalid_stock_code"], 0, True),
    ("h22", dict(quantity=-5.0, unit_price=0.0), ["inconsistent_return_price"], 0, True),
    ("h23", dict(quantity=None, unit_price=-1.0),
     ["incomplete_quantity", "invalid_quantity", "invalid_unit_price"], 0, False),
    ("h24", dict(invoice_no=" 536432 ", stock_code="22140-X", quantity=2.5,
                 customer_id=" 1.0 "), ["invalid_stock_code"], 0, True),
    ("h25", dict(description="", country="Nigeria"), ["invalid_country"], 1, True),
]


def _key(row):
    return tuple(
        repr(row[c]) for c in
        ("invoice_no", "stock_code", "description", "quantity", "invoice_date", "unit_price",
         "country")
    )


@pytest.fixture(scope="module")
def raw(spark):
    return lines(spark, [row for _, row, *_ in HAND_ROWS]).repartition(4).cache()


@pytest.fixture(scope="module")
def in_order(spark):
    return [r.asDict() for r in lines(spark, [row for _, row, *_ in HAND_ROWS]).collect()]


def test_each_row_raises_exactly_its_flags(spark, raw, in_order):
    found = {_key(r): r.asDict() for r in rowflags.flag_rows(spark, raw, RULES).collect()}
    for (name, _, expected, _, _), source in zip(HAND_ROWS, in_order, strict=True):
        row = found[_key(source)]
        raised = {
            c for c, v in row.items()
            if c.startswith(("incomplete", "invalid", "inconsistent", "is_")) and v == 1
        }
        assert raised == set(expected), name


def test_error_counts(spark, raw, in_order):
    found = {_key(r): r for r in rowflags.row_level_flags(spark, raw, RULES).collect()}
    for (name, _, expected, _, _), source in zip(HAND_ROWS, in_order, strict=True):
        row = found[_key(source)]
        assert row.error_count == len(expected), name
        assert row.affected_row == int(bool(expected)), name


def test_staging_and_logic_filter(raw, in_order):
    staged = staging.enrich(keep_latest(staging.stage(raw, RULES)))
    by_invoice = {r.invoice_no: r for r in staged.collect()}
    kept = {r.invoice_no for r in staging.keep_logical(staged).collect()}
    for (name, _, _, country_invalid, keep), source in zip(HAND_ROWS, in_order, strict=True):
        invoice = source["invoice_no"] and source["invoice_no"].strip(" ")
        if name == "h01":  # replaced by h02, the later row of the same key
            assert by_invoice[invoice].quantity == 2
            continue
        assert by_invoice[invoice].country_invalid == country_invalid, name
        assert (invoice in kept) == keep, name
    assert by_invoice["536432"].quantity == 2  # 2.5 rounds half to even
    assert by_invoice["536432"].customer_id == "1.0"
    assert by_invoice["536365"].revenue == 2 * by_invoice["536365"].unit_price


def test_usable_summary(spark, raw):
    row = usable.usable_summary(rowflags.row_level_flags(spark, raw, RULES)).first()
    assert (row.total_rows, row.clean_rows, row.affected_rows) == (25, 4, 21)
    assert round(row.avg_errors_per_affected_row, 4) == 1.5714
    assert str(row.pct_usable_data) == "16.00"
    assert row.data_quality_grade == "UNACCEPTABLE"
    assert row.drop_strategy_recommendation == "DO NOT DROP - Data loss too high"
    assert row.actionable_insight == (
        "Critical: Only 16.00% usable - Investigate root causes"
    )


@pytest.mark.parametrize(
    "clean, total, grade, strategy, insight",
    [
        (99, 100, "EXCELLENT", "SAFE TO DROP INVALID ROWS",
         "Safe to filter out 1 invalid rows (1.0% loss)"),
        (95, 100, "GOOD", "SAFE TO DROP INVALID ROWS",
         "Safe to filter out 5 invalid rows (5.0% loss)"),
        (181, 200, "ACCEPTABLE", "REVIEW BEFORE DROPPING",
         "Review 19 affected rows before dropping (9.5% loss)"),
        (85, 100, "POOR", "REVIEW BEFORE DROPPING",
         "Review 15 affected rows before dropping (15.0% loss)"),
        (70, 100, "UNACCEPTABLE", "SEGMENT - Keep clean subset only",
         "Critical: Only 70.00% usable - Investigate root causes"),
    ],
)
def test_grades(spark, clean, total, grade, strategy, insight):
    rows = spark.range(total).selectExpr(
        f"if(id < {clean}, 0, 1) AS affected_row", f"if(id < {clean}, 0, 1) AS error_count"
    )
    row = usable.usable_summary(rows).first()
    assert row.data_quality_grade == grade
    assert row.drop_strategy_recommendation == strategy
    assert row.actionable_insight == insight


def test_empty_table(spark, raw):
    empty = raw.limit(0)
    assert quality.completeness(empty).count() == 0
    assert quality.validity(empty, RULES).count() == 0
    unique = quality.uniqueness(empty).first()
    assert (unique.n_total, unique.composite_uniqueness_rate) == (0, None)
    consistent = quality.consistency(empty).first()
    assert consistent.n_total == 0 and consistent.sales_price_consistency_rate is None
    summary = usable.usable_summary(rowflags.row_level_flags(spark, empty, RULES)).first()
    assert (summary.total_rows, summary.pct_usable_data) == (0, None)
    assert summary.data_quality_grade == "UNACCEPTABLE"
    assert summary.actionable_insight == "Critical: Only % usable - Investigate root causes"


@pytest.mark.parametrize(
    "price, invalid",
    [(0.0, 0), (0.01, 0), (99999.99, 0), (99999.995, 1), (1.005, 1), (0.1 + 0.2, 0),
     (1e-20, 1), (0.004, 1), (0.005, 1), (4.35, 0), (1.1 * 3, 0), (8.41 + 1e-9, 1),
     (float("nan"), 1), (None, 1), (-0.01, 1)],
)
def test_price_rule(spark, price, invalid):
    flagged = quality.validity_flags(lines(spark, [{"unit_price": price}]), RULES)
    assert flagged.first().unit_price_invalid == invalid


def test_every_two_decimal_price_is_valid(spark):
    prices = spark.range(0, 10_000_000, 7).selectExpr("id / 100D AS unit_price")
    from pyspark.sql import functions as F

    from tillgrain.functions.flags import more_than_two_decimals

    assert prices.where(more_than_two_decimals(F.col("unit_price"))).count() == 0
    finer = spark.range(1, 1_000_000, 7).where("id % 10 <> 0").selectExpr("id / 1000D AS p")
    assert finer.where(~more_than_two_decimals(F.col("p"))).count() == 0
