"""Duplicate handling against brute force, with hot keys and copies."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from conftest import RULES, lines
from literal_forms import literal_metric_sections, literal_row_flags
from pyspark.sql import functions as F

from tillgrain.operators import quality, rowflags, scorecard, staging
from tillgrain.operators.dedup import (
    HOT_ROWS,
    RAW_TIE_BREAK,
    keep_latest,
    mark_duplicates,
)
from tillgrain.rules import RAW_COLUMNS


def _nulls_last(value):
    return (value is None, value)


def random_rows(seed: int, n: int, hot: dict) -> list[dict]:
    """A third of the rows share one key; another part are copies of one row."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        row = {
            "invoice_no": rng.choice([None, "", "536365", "536366", "C536367"]),
            "stock_code": rng.choice([None, "A", "B", " A"]),
            "quantity": rng.choice([None, 1.0, 2.0, -3.0]),
            "invoice_date": rng.choice(
                [None] + [datetime(2010, 1, 1) + timedelta(hours=h) for h in range(5)]
            ),
            "unit_price": rng.choice([None, 1.25, 2.5]),
            "customer_id": rng.choice([None, "1.0", "2.0"]),
            "description": rng.choice([None, "MUG", "CUP"]),
        }
        draw = rng.random()
        if draw < 0.34:
            row.update(hot)
        elif draw < 0.5:
            row = {"invoice_no": "777777", "stock_code": "COPY"}
        out.append(row)
    return out


HOT_KEYS = ({"invoice_no": None, "stock_code": None}, {"invoice_no": "1", "stock_code": "Z"})


# At 5 and 1 rows most repeated keys are ranked in two steps.
@pytest.mark.parametrize("hot_rows", [HOT_ROWS, 5, 1])
@pytest.mark.parametrize("hot", HOT_KEYS)
def test_marks_all_but_the_earliest(spark, hot, hot_rows):
    raw = lines(spark, random_rows(1, 600, hot)).repartition(6).cache()
    found = mark_duplicates(raw, hot_rows).collect()
    assert Counter(tuple(r[c] for c in RAW_COLUMNS) for r in found) == Counter(
        tuple(r) for r in raw.collect()
    )
    groups = defaultdict(list)
    for r in found:
        groups[(r.invoice_no, r.stock_code)].append(r)
    order = ("invoice_date", *RAW_TIE_BREAK)
    for rows in groups.values():
        firsts = [r for r in rows if r.is_duplicate == 0]
        assert len(firsts) == 1
        earliest = min(tuple(_nulls_last(r[c]) for c in order) for r in rows)
        assert tuple(_nulls_last(firsts[0][c]) for c in order) == earliest


def test_one_plan_of_any_size(spark, star):
    """No row count or key length decides between plans; only hashes are broadcast."""
    plan = mark_duplicates(star.raw)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftAnti") == plan.count("LeftSemi") == 1
    hot = plan[plan.index("ResolvedHint") if "ResolvedHint" in plan else plan.index("LeftAnti") :]
    assert "count(1)" in hot and "_hash" in hot


def test_no_task_gets_a_whole_hot_key(spark):
    """A key with a third of the rows is ranked in several tasks, beside a very long key."""
    raw = spark.range(0, 90_000, 1, 12).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id < 10 THEN repeat('x', 1000000) "
        "ELSE CAST(id AS STRING) END AS invoice_no", "'A' AS stock_code",
        "'MUG' AS description", "1D AS quantity",
        "TIMESTAMP_NTZ '2010-01-01' + make_dt_interval(0, 0, 0, id) AS invoice_date",
        "1.25D AS unit_price", "'1.0' AS customer_id", "'France' AS country",
    )
    marked = mark_duplicates(raw, hot_rows=5_000)
    assert marked.agg(F.sum("is_duplicate")).first()[0] == 29_999 + 5
    option = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(option, "false")  # the test's few rows would be put together again
    try:
        # The flag stays in the result, else the last ranking would be left out.
        parts = marked.select("invoice_no", "is_duplicate", F.spark_partition_id().alias("part"))
        hot = parts.where("invoice_no = 'hot'").groupBy("part").agg(
            F.count(F.lit(1)).alias("count"), F.sum("is_duplicate").alias("again")
        ).collect()
    finally:
        spark.conf.unset(option)
    assert sum(r["again"] for r in hot) == 29_999
    assert max(r["count"] for r in hot) < 15_000


def test_keep_latest_prefers_unknown_date_then_ties(spark):
    day = datetime(2010, 1, 1)
    raw = lines(
        spark,
        [
            dict(invoice_no="1", invoice_date=day),
            dict(invoice_no="1", invoice_date=None, quantity=5.0),
            dict(invoice_no=" 2 ", invoice_date=day, quantity=7.0),
            dict(invoice_no="2", invoice_date=day, quantity=3.0),
            dict(invoice_no=None, invoice_date=day),
            dict(invoice_no=None, invoice_date=day + timedelta(1)),
        ],
    )
    kept = {r.invoice_no: r for r in keep_latest(staging.stage(raw, RULES)).collect()}
    assert len(kept) == 3
    assert kept["1"].invoice_date is None
    assert kept["2"].quantity == 3
    assert kept[None].invoice_date == day + timedelta(1)
    assert {r.rn for r in kept.values()} == {1}


def test_keep_latest_prunes_before_the_shuffle(star):
    plan = star.txn_deduplicated._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_uniqueness_ignores_unknown_keys(spark):
    raw = lines(
        spark,
        [dict(invoice_no="1")] * 3
        + [dict(invoice_no="2")] * 2
        + [dict(invoice_no=None)] * 4
        + [dict(invoice_no="3", stock_code=None)] * 2,
    )
    groups = {r.invoice_no: r.occurrence_count for r in quality.duplicate_groups(raw).collect()}
    assert groups == {"1": 3, "2": 2}
    row = quality.uniqueness(raw).first()
    assert (row.n_total, row.composite_duplicate_group_count) == (5, 2)
    assert row.composite_duplicate_row_count == 3
    assert str(row.composite_uniqueness_rate) == "0.4000"


def test_row_ids(spark):
    raw = lines(spark, random_rows(4, 500, {"invoice_date": None})).repartition(7)
    numbered = rowflags.with_row_id(spark, raw).collect()
    assert sorted(r.row_id for r in numbered) == list(range(1, 501))
    in_order = sorted(numbered, key=lambda r: r.row_id)
    keys = [tuple(_nulls_last(r[c]) for c in rowflags.ROW_ORDER) for r in in_order]
    assert keys == sorted(keys)
    assert Counter(tuple(r[c] for c in RAW_COLUMNS) for r in numbered) == Counter(
        tuple(r) for r in raw.collect()
    )


def test_row_ids_add_no_second_shuffle_of_the_rows(spark, star):
    plan = rowflags.with_row_id(spark, star.raw)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning(_position" not in plan


def test_flag_totals_match_the_section_counts(star):
    """Row flags and aggregate metrics count the same failures."""
    flags = rowflags.flag_rows(star.spark, star.raw, star.rules)
    names = [c for c in flags.columns if c not in rowflags.OUTPUT_COLUMNS]
    totals = flags.agg(*[F.sum(c).alias(c) for c in names]).first().asDict()
    expected = {
        "incomplete_invoice_no": 75, "incomplete_stock_code": 60,
        "incomplete_description": 461, "incomplete_quantity": 23,
        "incomplete_invoice_date": 36, "incomplete_unit_price": 48,
        "incomplete_country": 121, "invalid_country": 588, "invalid_stock_code": 86,
        "invalid_invoice_no": 115, "invalid_description": 503, "invalid_quantity": 93,
        "invalid_invoice_date": 79, "invalid_unit_price": 211,
        "inconsistent_sales_price": 134, "inconsistent_return_price": 7, "is_duplicate": 59,
    }
    assert totals == expected
    complete, valid = star.dq_completeness.first(), star.dq_validity.first()
    for c in ("invoice_no", "stock_code", "description", "quantity", "country"):
        assert complete[f"{c}_incomplete_count"] == expected[f"incomplete_{c}"]
        assert valid[f"{c}_invalid_count"] == expected[f"invalid_{c}"]


def test_single_pass_equals_joined_flags(star):
    mine = star.dq_row_level_flags.drop("dq_checked_at")
    literal = literal_row_flags(star.raw, star.rules)
    assert Counter(mine.collect()) == Counter(literal.select(*mine.columns).collect())


def test_fused_scorecard_equals_separate_sections(star):
    fused = scorecard.metric_rows(star.raw, star.rules).select("metric_value", "rate")
    literal = literal_metric_sections(star.raw, star.rules).select("metric_value", "rate")
    assert Counter(fused.collect()) == Counter(literal.collect())
