"""Snapshot and RFM facts: hand case, literal forms, incremental runs."""

from __future__ import annotations

from collections import Counter
from datetime import date, datetime

import pytest
from conftest import RULES, lines
from literal_forms import literal_grain, literal_rfm
from pyspark.sql import functions as F

from tillgrain.functions.months import month_index
from tillgrain.operators import calendar, rfm, snapshot, staging
from tillgrain.operators.dedup import keep_latest
from tillgrain.operators.upsert import upsert
from tillgrain.plans import incremental
from tillgrain.rules import CleanRules
from tillgrain.sources.star_adapter import STAR_RULES
from tillgrain.sources.tables import materialise

CUT = "2000-07-01 00:00:00"


def filtered_lines(spark, rows):
    raw = lines(spark, rows)
    return staging.keep_logical(staging.enrich(keep_latest(staging.stage(raw, RULES))))


def same(a, b) -> bool:
    columns = sorted(a.columns)
    return Counter(a.select(*columns).collect()) == Counter(b.select(*columns).collect())


def test_one_customer_by_hand(spark):
    filtered = filtered_lines(
        spark,
        [
            dict(invoice_no="000001", invoice_date=datetime(2010, 1, 15, 10), unit_price=100.0),
            dict(invoice_no="000002", invoice_date=datetime(2010, 3, 20, 13), unit_price=50.0),
            dict(invoice_no="C00003", invoice_date=datetime(2010, 3, 20, 13), quantity=-1.0,
                 unit_price=20.0),
        ],
    )
    expected = [
        (date(2010, 1, 1), True, 1, 0, 0, 100.0),
        (date(2010, 2, 1), False, 2, 16, 0, 100.0),
        (date(2010, 3, 1), True, 3, 0, 2, 130 / 3),
    ]
    grain = snapshot.composite_grain(filtered, RULES)
    for facts in (rfm.rfm_full_refresh(filtered, RULES), rfm.rfm(grain, filtered)):
        rows = sorted(tuple(r)[1:] for r in facts.collect())
        assert rows == expected


def test_customers_outside_the_dimension(spark):
    filtered = filtered_lines(
        spark,
        [
            dict(customer_id="early", invoice_date=datetime(2009, 11, 5)),
            dict(customer_id="early", invoice_date=datetime(2010, 2, 5)),
            dict(customer_id="late", invoice_date=datetime(2012, 1, 5)),
            dict(customer_id="open", invoice_date=datetime(2011, 11, 5)),
            dict(customer_id="open", invoice_date=datetime(2999, 1, 1)),
            dict(customer_id="undated", invoice_date=None),
            dict(customer_id=None),
        ],
    )
    grain = snapshot.composite_grain(filtered, RULES)
    rows = {(r.customer_id, r.snapshot_date, r.had_activity) for r in grain.collect()}
    assert rows == {("open", date(2011, 11, 1), True), ("open", date(2011, 12, 1), False)}
    dim = calendar.month_dimension(spark, RULES)
    assert same(grain, literal_grain(filtered, dim, snapshot.activity_months(filtered)))
    assert {r.customer_id for r in snapshot.activity_months(filtered).collect()} == {
        "early", "late", "open", "undated"
    }


def test_dimension_bounds(spark):
    months = [r.month_start for r in calendar.month_dimension(spark, CleanRules()).collect()]
    assert (len(months), min(months), max(months)) == (25, date(2009, 12, 1), date(2011, 12, 1))


def test_window_forms_equal_literal_joins(spark, filtered):
    dim = calendar.month_dimension(spark, STAR_RULES)
    grain = snapshot.composite_grain(filtered, STAR_RULES)
    literal = literal_grain(filtered, dim, snapshot.activity_months(filtered))
    assert grain.count() == 9951
    assert same(grain, literal)
    full = rfm.rfm_full_refresh(filtered, STAR_RULES)
    assert same(full, rfm.rfm(grain, filtered))
    assert same(full, literal_rfm(literal, filtered))


def test_rfm_of_a_grain_with_holes(spark, filtered):
    grain = snapshot.composite_grain(filtered, STAR_RULES)
    holes = materialise(
        spark, grain.where("pmod(hash(customer_id, snapshot_date), 4) <> 0"), "holes"
    )
    assert same(rfm.rfm(holes, filtered), literal_rfm(holes, filtered))


def test_spine_and_first_month(spark, filtered):
    bounds = snapshot.customer_bounds(filtered)
    dim = calendar.month_dimension(spark, STAR_RULES)
    spine = snapshot.month_spine(bounds, STAR_RULES)
    ranged = bounds.join(
        dim, F.col("month_start").between(F.col("first_month"), F.col("last_month"))
    ).select(
        "customer_id", F.col("month_start").alias("snapshot_date"), "first_month",
        F.col("month_index").alias("snapshot_month_index"),
    )
    assert same(spine, ranged)
    first = snapshot.first_month_index(bounds, STAR_RULES)
    assert first.count() == 150
    assert first.join(bounds, "customer_id").where(
        F.col("first_month_index") != month_index(F.col("first_month"))
    ).isEmpty()


@pytest.fixture(scope="module")
def earlier(spark, filtered):
    before = filtered.where(F.col("invoice_date") < F.lit(CUT))
    return before, materialise(spark, snapshot.composite_grain(before, STAR_RULES), "target")


def test_look_back_leaves_holes(filtered, earlier):
    _, target = earlier
    delta = incremental.grain_delta(target, filtered, STAR_RULES)
    merged = incremental.grain_incremental(target, filtered, STAR_RULES)
    full = snapshot.composite_grain(filtered, STAR_RULES)
    assert (target.count(), delta.count(), merged.count()) == (7591, 1726, 9273)
    missing = full.join(merged, ["customer_id", "snapshot_date"], "left_anti")
    assert missing.count() == 678
    assert missing.select("customer_id").distinct().count() == 86


def test_affected_customers_equals_full_refresh(filtered, earlier):
    _, target = earlier
    merged = incremental.grain_incremental(
        target, filtered, STAR_RULES, mode="affected_customers"
    )
    assert same(merged, snapshot.composite_grain(filtered, STAR_RULES))


def test_first_run_on_an_empty_target_is_a_full_refresh(filtered, earlier):
    _, target = earlier
    full = snapshot.composite_grain(filtered, STAR_RULES)
    for mode in incremental.MODES:
        merged = incremental.grain_incremental(target.limit(0), filtered, STAR_RULES, mode)
        assert same(merged, full)


def test_late_line_within_a_known_month(spark, filtered, earlier):
    """A month that turns active long before the look-back is repaired."""
    _, target = earlier
    quiet = target.where("NOT had_activity").orderBy("customer_id", "snapshot_date").first()
    late = filtered.limit(1).withColumns(
        {
            "customer_id": F.lit(quiet.customer_id),
            "invoice_date": F.lit(str(quiet.snapshot_date)).cast("timestamp_ntz"),
        }
    )
    current = materialise(spark, filtered.unionByName(late), "late")
    merged = incremental.grain_incremental(target, current, STAR_RULES, "affected_customers")
    assert same(merged, snapshot.composite_grain(current, STAR_RULES))


def test_moved_and_vanished_months(spark, filtered, earlier):
    """Late copies that move a first, a middle and a last month, and a customer who is gone."""
    before, target = earlier
    days = before.select("customer_id", F.col("invoice_date").alias("d")).where("customer_id IS NOT NULL")
    spans = days.groupBy("customer_id").agg(F.min("d").alias("a"), F.max("d").alias("z"), F.count("*").alias("n"))
    some = [r.customer_id for r in spans.where("n > 8").orderBy("customer_id").limit(4).collect()]
    months = F.expr("INTERVAL 40 DAYS")
    date_, who = F.col("invoice_date"), F.col("customer_id")
    ends = spans.select("customer_id", "a", "z")
    moved = before.join(F.broadcast(ends), "customer_id", "left").withColumn(
        "invoice_date",
        F.when((who == some[0]) & (date_ == F.col("a")), date_ + months)
        .when((who == some[1]) & (date_ == F.col("z")), date_ - months)
        .when((who == some[2]) & (date_ > F.col("a")) & (date_ < F.col("z")), F.col("z"))
        .otherwise(date_),
    ).where(~F.coalesce(who == some[3], F.lit(False))).select(*before.columns)
    current = materialise(spark, moved, "moved")
    full = snapshot.composite_grain(current, STAR_RULES)
    assert not same(target, full)
    assert same(incremental.grain_incremental(target, current, STAR_RULES, "affected_customers"), full)
    metrics = materialise(spark, rfm.rfm_full_refresh(before, STAR_RULES), "metrics")
    monthly = materialise(spark, rfm.monthly_transactions(before), "monthly")
    got = incremental.rfm_of_affected(metrics, monthly, current, STAR_RULES)
    assert same(got, rfm.rfm_full_refresh(current, STAR_RULES))


def test_rfm_incremental_reprocesses_the_look_back(spark, filtered, earlier):
    before, target_grain = earlier
    target = materialise(spark, rfm.rfm_full_refresh(before, STAR_RULES), "target_rfm")
    grain = materialise(
        spark, incremental.grain_incremental(target_grain, filtered, STAR_RULES), "grain"
    )
    merged = incremental.rfm_incremental(target, grain, filtered)
    since = date(2000, 5, 1)
    recent = F.col("snapshot_date") >= F.lit(since)
    assert same(merged.where(recent), rfm.rfm(grain, filtered).where(recent))
    assert same(merged.where(~recent), target.where(~recent))


def test_upsert_replaces_and_keeps(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k INT, v STRING")
    delta = spark.createDataFrame([("B", 2), ("D", 4)], "v STRING, k INT")
    expected = {(1, "a"), (2, "B"), (3, "c"), (4, "D")}
    assert {tuple(r) for r in upsert(target, delta, ["k"]).collect()} == expected
    settled = upsert(target, delta, ["k"], settled=F.col("k") < 2)
    assert {tuple(r) for r in settled.collect()} == expected


def test_plans_have_no_range_or_cross_join(star):
    for df in (star.composite_grain, star.customer_rfm, star.dq_row_level_flags, star.dq_summary):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
