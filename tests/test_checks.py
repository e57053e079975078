"""Generic checks and named assertions: each finds a planted violation."""

from __future__ import annotations

from collections import Counter
from datetime import date, datetime

import pytest
from conftest import RULES, lines
from pyspark.sql import functions as F

from tillgrain.operators import assertions, checks
from tillgrain.plans import suite
from tillgrain.plans.pipeline import Lakehouse


@pytest.fixture(scope="module")
def tables(spark):
    t = spark.createDataFrame(
        [(1, "a", 1.0), (2, "b", None), (2, None, -3.0), (None, "z", 4.0), (5, "z", 5.0)],
        "k INT, label STRING, x DOUBLE",
    )
    return {
        "t": t,
        "parent": spark.createDataFrame([(1,), (1,), (5,)], "id INT"),
        "void": t.where("k = 5").withColumn("x", F.lit(None).cast("double")),
    }


def outcomes(found, tables):
    return {r.check_name: (r.failing_rows, r.severity) for r in
            checks.results(found, tables).collect()}


def test_each_kind_counts_its_failures(tables):
    found = [
        checks.not_null("t", "x"),
        checks.unique("t", "k"),
        checks.accepted_values("t", "label", ["a"]),
        checks.relationships("t", "k", "parent", "id"),
        checks.expression_is_true("t", "x_positive", "x > 0"),
        checks.unique_combination("t", ("label",), severity="warn"),
        checks.at_least_one("t", "x"),
        checks.at_least_one("void", "x"),
        checks.equal_row_count("t", "parent"),
        checks.equal_row_count("t", "t"),
        checks.row_count_is("t", 5),
        checks.row_count_is("t", 1),
    ]
    assert outcomes(found, tables) == {
        "t.x.not_null": (1, "error"),
        "t.k.unique": (1, "error"),
        "t.label.accepted_values": (2, "error"),  # b and z; unknown passes
        "t.k.relationships": (2, "error"),  # both rows with k = 2
        "t.x_positive": (1, "error"),
        "t.label.unique": (1, "warn"),
        "t.x.at_least_one": (0, "error"),
        "void.x.at_least_one": (1, "error"),
        "t.row_count_equals.parent": (2, "error"),
        "t.row_count_equals.t": (0, "error"),
        "t.row_count_is_5": (0, "error"),
        "t.row_count_is_1": (4, "error"),
    }


def test_unknown_keys_count_as_equal_only_in_combinations(spark):
    t = {"t": spark.createDataFrame([(None,), (None,), (1,)], "k INT")}
    assert outcomes([checks.unique("t", "k")], t)["t.k.unique"][0] == 0
    assert outcomes([checks.unique_combination("t", ("k",))], t)["t.k.unique"][0] == 1


def test_violating_rows(tables):
    v = checks.violations
    assert [r.k for r in v(checks.not_null("t", "x"), tables).collect()] == [2]
    assert {r.label: r.n_records for r in
            v(checks.accepted_values("t", "label", ["a"]), tables).collect()} == {"b": 1, "z": 2}
    orphan = v(checks.relationships("t", "k", "parent", "id"), tables).first()
    assert (orphan.value, orphan.n_records) == (2, 2)
    assert v(checks.unique("t", "k"), tables).first().n_records == 2
    assert v(checks.row_count_is("t", 1), tables).count() == 1


def test_verdict_follows_severity(tables):
    rows = checks.verdicts(
        checks.results(
            [
                checks.not_null("t", "x"),
                checks.not_null("t", "label", severity="warn"),
                checks.not_null("parent", "id"),
            ],
            tables,
        )
    ).collect()
    assert [r.outcome for r in rows] == ["fail", "warn", "pass"]


def test_row_checks_of_a_table_share_one_scan(tables):
    found = [checks.not_null("t", c) for c in ("k", "label", "x")]
    plan = checks.results(found, tables)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


def test_declared_suite_has_the_agreed_checks():
    kinds = Counter(c.kind for c in suite.all_checks())
    assert kinds == {
        "not_null": 108, "expression": 88, "accepted_values": 14, "unique_combination": 4,
        "unique": 2, "relationships": 1, "at_least_one": 1, "equal_row_count": 1,
        "row_count": 1,
    }
    assert len({c.name for c in suite.all_checks()}) == 220
    assert sum(c.severity == "warn" for c in suite.all_checks()) == 2


def test_suite_passes_on_clean_lines(spark):
    raw = lines(
        spark,
        [
            dict(customer_id=f"{i % 7}.0", invoice_date=datetime(2010, 1 + i % 12, 3, 9))
            for i in range(60)
        ]
        + [dict(invoice_no="C536379", quantity=-1.0, invoice_date=datetime(2010, 12, 9))],
    )
    house = Lakehouse(spark, raw, RULES)
    rows = checks.verdicts(checks.results(suite.all_checks(), house)).collect()
    assert len(rows) == 220
    assert [r for r in rows if r.outcome != "pass"] == []
    for id in assertions.ASSERTIONS:
        assert assertions.violations(id, house, RULES).isEmpty(), id


# -- assertions on planted violations -------------------------------------------

STAGED = (
    "invoice_no STRING, stock_code STRING, quantity INT, unit_price DECIMAL(10,2),"
    " invoice_date TIMESTAMP_NTZ, customer_id STRING, country STRING, country_invalid INT"
)
GRAIN = (
    "customer_id STRING, snapshot_date DATE, had_activity BOOLEAN,"
    " months_since_first_purchase INT"
)
RFM = f"{GRAIN}, recency_days INT, frequency BIGINT, monetary_value DOUBLE"
DAY = datetime(2010, 1, 5)


def line(**changes):
    row = dict(invoice_no="1", stock_code="A", quantity=1, unit_price=1, invoice_date=DAY,
               customer_id="c", country="France", country_invalid=0)
    return {**row, **changes}


def table(spark, rows, schema):
    from decimal import Decimal

    names = [f.strip().split()[0] for f in schema.replace("(10,2)", "").split(",")]
    fix = lambda n, v: Decimal(v) if n in ("unit_price", "revenue") and v is not None else v
    return spark.createDataFrame([tuple(fix(n, r.get(n)) for n in names) for r in rows], schema)


def m(i):
    return date(2010, i, 1)


PLANTED = {
    "a1": ("stg_cleaned", STAGED,
           [line(country="Nigeria"), line(country="U.S.A."), line(country=None), line()], 2),
    "a2": ("stg_cleaned", STAGED, [line(country_invalid=1), line()], 1),
    "a3": ("stg_cleaned", STAGED,
           [line(country=" France"), line(customer_id="c "), line(customer_id=None)], 2),
    "a4": ("stg_cleaned", STAGED,
           [line(quantity=None, unit_price=None), line(invoice_date=None), line()], 2),
    # a missing country, a bad flag, a row failing twice, and one repeated key
    "a5": ("txn_deduplicated", f"{STAGED}, rn INT",
           [line(rn=1, country=None), line(rn=1, invoice_no="2", country_invalid=3),
            line(rn=2, invoice_no="3", quantity=None), line(rn=1, invoice_no="4"),
            line(rn=1, invoice_no="4")], 5),
    "a7": ("txn_filtered", STAGED, [line(unit_price=-1), line(quantity=-1, unit_price=-1)], 1),
    "a10": ("dim_months", "month_start DATE, month_index INT",
            [dict(month_start=m(1), month_index=1)], 1),
    "a11": ("dim_months", "month_start DATE, month_index INT",
            [dict(month_start=m(i), month_index=0) for i in (1, 2, 4, 4)], 2),
    "a12": ("dim_months", "month_start DATE, month_index INT",
            [dict(month_start=m(1), month_index=2010 * 12 + 1),
             dict(month_start=m(2), month_index=2010 * 12 + 1)], 1),
    "a14": ("composite_grain", GRAIN,
            [dict(customer_id="c", snapshot_date=m(i), months_since_first_purchase=v)
             for i, v in ((1, 1), (2, 1), (3, 2))]
            + [dict(customer_id="d", snapshot_date=m(1), months_since_first_purchase=1)], 1),
    "a15": ("composite_grain", GRAIN,
            [dict(customer_id="c", snapshot_date=date(2026, 2, 1)),
             dict(customer_id="c", snapshot_date=date(2026, 1, 1))], 1),
    "a16": ("composite_grain", GRAIN,
            [dict(customer_id="c", snapshot_date=m(i)) for i in (1, 3, 4)], 1),
    "a17": ("customer_rfm", RFM,
            [dict(had_activity=True, recency_days=None), dict(had_activity=True, recency_days=0),
             dict(had_activity=True, recency_days=2), dict(had_activity=False)], 2),
    "a18": ("customer_rfm", RFM,
            [dict(monetary_value=1.0), dict(monetary_value=1.0, recency_days=0), dict()], 1),
    "a19": ("customer_rfm", RFM, [dict(recency_days=-1), dict(recency_days=0), dict()], 1),
    "a20": ("customer_rfm", RFM,
            [dict(customer_id="c", snapshot_date=m(i), had_activity=a, recency_days=r)
             for i, a, r in ((1, False, 9), (2, False, 3), (3, True, 0), (4, False, 5))], 1),
    "a21": ("customer_rfm", RFM,
            [dict(had_activity=False), dict(had_activity=True),
             dict(had_activity=False, recency_days=1)], 1),
    "a22": ("customer_rfm", RFM,
            [dict(customer_id="c", snapshot_date=d) for d in (m(1), m(1), m(2))], 1),
    "a23": ("dq_row_level_flags", "affected_row INT, error_count INT",
            [dict(affected_row=0, error_count=1), dict(affected_row=1, error_count=0),
             dict(affected_row=1, error_count=2), dict(affected_row=0, error_count=0)], 2),
    "a24": ("dq_row_level_flags", "affected_row INT, error_count INT",
            [dict(error_count=-1), dict(error_count=0)], 1),
    "a26": ("dq_usable_summary", "total_rows BIGINT, clean_rows BIGINT, affected_rows BIGINT",
            [dict(total_rows=3, clean_rows=1, affected_rows=1)], 1),
}


@pytest.mark.parametrize("id", PLANTED)
def test_assertion_finds_planted_rows(spark, id):
    name, schema, rows, expected = PLANTED[id]
    row = assertions.outcome(id, {name: table(spark, rows, schema)}, RULES).first()
    assert row.failing_rows == expected
    assert row.check_name.startswith(f"{id}_")


def test_revenue_assertion(spark):
    schema = "quantity INT, unit_price DOUBLE, revenue DOUBLE"

    def kinds(rows):
        tables = {"txn_enriched": spark.createDataFrame(rows, schema)}
        found = assertions.violations("a6", tables, RULES).collect()
        return Counter(r.failure_type for r in found)

    assert kinds([(1, 1.0, 1.0), (2, 1.0, 1.0), (3, 1.0, None)]) == {
        "not_null_revenue": 1, "invalid_revenue_calculation": 1
    }
    assert kinds([(1, 1.0, None), (2, 1.0, None)]) == {
        "not_null_revenue": 2, "no_revenue_present": 2
    }


def test_activity_assertions(spark):
    filtered = table(spark, [line(), line(customer_id="d", invoice_date=None)], STAGED)
    months = spark.createDataFrame(
        [("c", m(1)), ("c", m(2)), ("d", None), ("e", m(1))],
        "customer_id STRING, activity_month DATE",
    )
    tables = {"txn_filtered": filtered, "customer_activity_months": months}
    late = assertions.violations("a8", tables, RULES).collect()
    assert [(r.customer_id, r.activity_month) for r in late] == [("c", m(2))]
    unbacked = assertions.violations("a9", tables, RULES).collect()
    assert {(r.customer_id, r.activity_month) for r in unbacked} == {
        ("c", m(2)), ("d", None), ("e", m(1))
    }
    grain = table(
        spark,
        [dict(customer_id="c", snapshot_date=m(1), had_activity=False),
         dict(customer_id="c", snapshot_date=m(2), had_activity=True),
         dict(customer_id="c", snapshot_date=m(3), had_activity=True)],
        GRAIN,
    )
    wrong = assertions.violations("a13", {**tables, "composite_grain": grain}, RULES)
    assert {r.snapshot_date for r in wrong.collect()} == {m(1), m(3)}


def test_usable_share_assertion(spark):
    t = spark.sql(
        "SELECT 3L AS total_rows, 1L AS clean_rows, CAST(33.33 AS DECIMAL(5,2)) AS pct_usable_data"
        " UNION ALL SELECT 3L, 1L, CAST(33.34 AS DECIMAL(5,2))"
    )
    assert assertions.outcome("a25", {"dq_usable_summary": t}, RULES).first().failing_rows == 1


def test_scorecard_assertions(star):
    card = star.dq_summary.cache()
    for id in ("a27", "a28", "a29", "a30", "a31", "a32", "a33"):
        assert assertions.outcome(id, {"dq_summary": card}, RULES).first().failing_rows == 0
    broken = card.where("dimension <> 'overall' AND check_name <> 'country'").unionByName(
        card.where("dimension = 'overall'").withColumn("rate", F.lit(0.1).cast("decimal(5,4)"))
    ).where("dimension <> 'uniqueness'")
    failing = {
        id: assertions.outcome(id, {"dq_summary": broken}, RULES).first().failing_rows
        for id in ("a27", "a28", "a29", "a30", "a31", "a32", "a33")
    }
    assert failing == {"a27": 1, "a28": 1, "a29": 1, "a30": 1, "a31": 0, "a32": 0, "a33": 1}
