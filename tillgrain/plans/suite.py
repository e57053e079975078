"""Column and table expectations declared for every table.

Most follow from how a column is named or used, so they are stated as rules:
counts are present and not negative, rates lie between 0 and 1, percentages
between 0 and 100, flags are 0 or 1.
"""

from __future__ import annotations

from tillgrain.functions.flags import COMPLETENESS_COLUMNS, VALIDITY_COLUMNS
from tillgrain.operators.checks import (
    Check,
    accepted_values,
    at_least_one,
    equal_row_count,
    expression_is_true,
    not_null,
    relationships,
    row_count_is,
    unique,
    unique_combination,
)
from tillgrain.rules import DQ_MODEL, GRADES, GRAIN_KEY, LOWEST_GRADE, ROW_KEY, CleanRules


def _present(table: str, *columns: str) -> list[Check]:
    return [not_null(table, c) for c in columns]


def _bounded(table: str, columns: tuple[str, ...], low: int, high: int | None) -> list[Check]:
    """Present and within [low, high]; no upper bound when high is None."""
    out = _present(table, *columns)
    for c in columns:
        if high is None:
            out.append(expression_is_true(table, f"{c}.at_least_{low}", f"{c} >= {low}"))
        else:
            out.append(
                expression_is_true(
                    table, f"{c}.between_{low}_and_{high}", f"{c} BETWEEN {low} AND {high}"
                )
            )
    return out


def _derived(table: str, count: str, total: str, rate: str, complement: bool) -> Check:
    """The stored rate equals the rate recomputed from its counts."""
    ratio = (
        f"CAST({count} AS DECIMAL(18,0)) / CAST(NULLIF({total}, 0) AS DECIMAL(18,0))"
    )
    recomputed = f"round(1 - {ratio}, 4)" if complement else f"round({ratio}, 4)"
    return expression_is_true(table, f"{rate}.derived_from_counts", f"{recomputed} = {rate}")


def _model(table: str, dimension: str) -> list[Check]:
    return [
        *_present(table, "dq_model", "run_at"),
        accepted_values(table, "dq_model", [DQ_MODEL[dimension]]),
    ]


def staging_checks() -> list[Check]:
    t = "stg_cleaned"
    return [
        *_present(
            t, "stock_code", "quantity", "unit_price", "invoice_date", "country",
            "country_invalid",
        ),
        accepted_values(t, "country_invalid", [0, 1]),
    ]


def transaction_checks() -> list[Check]:
    d, a = "txn_deduplicated", "customer_activity_months"
    return [
        *_present(
            d, "stock_code", "quantity", "unit_price", "invoice_date", "country",
            "country_invalid", "rn",
        ),
        accepted_values(d, "country_invalid", [0, 1]),
        accepted_values(d, "rn", [1]),
        unique_combination(d, ROW_KEY, severity="warn"),
        not_null("txn_enriched", "revenue"),
        at_least_one("txn_enriched", "revenue", severity="warn"),
        expression_is_true(
            "txn_filtered", "no_negative_sale_price", "NOT (quantity > 0 AND unit_price < 0)"
        ),
        *_present(a, "customer_id", "activity_month"),
        unique_combination(a, ("customer_id", "activity_month")),
    ]


def dimension_checks() -> list[Check]:
    t = "dim_months"
    return [
        *_present(t, "month_start", "month_index", "year", "month_num"),
        unique(t, "month_start"),
        unique(t, "month_index"),
        accepted_values(t, "month_num", range(1, 13)),
    ]


def fact_checks() -> list[Check]:
    g, r = "composite_grain", "customer_rfm"
    grain = ("customer_id", "snapshot_date", "had_activity", "months_since_first_purchase")
    return [
        *_present(g, *grain),
        relationships(g, "customer_id", "txn_filtered", "customer_id"),
        unique_combination(g, GRAIN_KEY),
        *_present(r, *grain, "frequency"),
        expression_is_true(r, "recency_not_negative", "recency_days >= 0"),
        expression_is_true(r, "frequency_not_negative", "frequency >= 0"),
        expression_is_true(r, "monetary_not_negative", "monetary_value >= 0"),
        unique_combination(r, GRAIN_KEY),
    ]


def completeness_checks() -> list[Check]:
    t = "dq_completeness"
    counts = tuple(f"{c}_incomplete_count" for c in COMPLETENESS_COLUMNS if c != "customer_id")
    rates = tuple(
        f"{c}_completeness_rate" for c in COMPLETENESS_COLUMNS if c != "customer_id"
    )
    return [
        *_bounded(
            t, ("n_total", "fully_complete_row_count", "incomplete_row_count", *counts), 0, None
        ),
        *_bounded(t, (*rates, "fully_complete_row_rate"), 0, 1),
        *_present(t, "customer_id_completeness_rate", "customer_id_incomplete_count"),
        accepted_values(t, "customer_id_completeness_rate", [1.0]),
        accepted_values(t, "customer_id_incomplete_count", [0]),
        expression_is_true(
            t, "complete_rows_within_total", "fully_complete_row_count <= n_total"
        ),
        expression_is_true(
            t,
            "incomplete_rows_are_the_rest",
            "incomplete_row_count = n_total - fully_complete_row_count",
        ),
        *[
            _derived(t, f"{c}_incomplete_count", "n_total", f"{c}_completeness_rate", True)
            for c in ("invoice_no", "stock_code", "country")
        ],
        equal_row_count(t, t),
        row_count_is(t, 1),
        *_model(t, "completeness"),
    ]


def validity_checks() -> list[Check]:
    t = "dq_validity"
    counts = tuple(f"{c}_invalid_count" for c in VALIDITY_COLUMNS if c != "country")
    rates = tuple(f"{c}_validity_rate" for c in VALIDITY_COLUMNS)
    return [
        *_bounded(
            t, ("n_total", "fully_valid_row_count", "invalid_row_count", *counts), 0, None
        ),
        *_bounded(t, (*rates, "fully_valid_row_rate"), 0, 1),
        expression_is_true(t, "valid_rows_within_total", "fully_valid_row_count <= n_total"),
        expression_is_true(
            t, "invalid_rows_are_the_rest", "invalid_row_count = n_total - fully_valid_row_count"
        ),
        *[
            _derived(t, f"{c}_invalid_count", "n_total", f"{c}_validity_rate", True)
            for c in ("invoice_no", "quantity", "unit_price")
        ],
        _derived(t, "fully_valid_row_count", "n_total", "fully_valid_row_rate", False),
        *_model(t, "validity"),
    ]


def uniqueness_checks() -> list[Check]:
    t = "dq_uniqueness"
    groups, rows = "composite_duplicate_group_count", "composite_duplicate_row_count"
    return [
        *_bounded(t, ("n_total", groups, rows), 0, None),
        *_bounded(t, ("composite_uniqueness_rate",), 0, 1),
        expression_is_true(t, "duplicate_rows_within_total", f"{rows} <= n_total"),
        expression_is_true(t, "duplicate_rows_cover_groups", f"{rows} >= {groups}"),
        _derived(t, rows, "n_total", "composite_uniqueness_rate", True),
        expression_is_true(
            t,
            "no_groups_means_rate_one",
            f"({groups} = 0 AND composite_uniqueness_rate = 1) OR {groups} > 0",
        ),
        *_model(t, "uniqueness"),
    ]


def consistency_checks() -> list[Check]:
    t = "dq_consistency"
    rules = (
        ("sale_with_zero_price_count", "total_sale_rows", "sales_price_consistency_rate"),
        (
            "return_with_nonpositive_price_count",
            "total_return_rows",
            "return_price_consistency_rate",
        ),
    )
    out = _bounded(t, ("n_total",), 0, None)
    for failing, total, rate in rules:
        out += [
            *_bounded(t, (failing, total), 0, None),
            *_bounded(t, (rate,), 0, 1),
            expression_is_true(t, f"{failing}.within_{total}", f"{failing} <= {total}"),
            expression_is_true(t, f"{total}.within_n_total", f"{total} <= n_total"),
            _derived(t, failing, total, rate, True),
        ]
    return [
        *out,
        expression_is_true(
            t, "sales_and_returns_within_total",
            "total_sale_rows + total_return_rows <= n_total",
        ),
        *_model(t, "consistency"),
    ]


def scorecard_checks(rules: CleanRules) -> list[Check]:
    t = "dq_summary"
    return [
        *_present(t, "dimension", "check_name", "metric_name", "status", "run_at"),
        *_bounded(t, ("rate",), 0, 1),
        *_bounded(t, ("n_total",), 0, None),
        accepted_values(t, "dimension", [*DQ_MODEL, "overall"]),
        accepted_values(t, "status", ["PASS", "WARN", "FAIL"]),
        expression_is_true(
            t, "metric_value_not_negative", "metric_value IS NULL OR metric_value >= 0"
        ),
        expression_is_true(
            t,
            "status_matches_rate",
            f"status = CASE WHEN rate >= {rules.pass_rate} THEN 'PASS'"
            f" WHEN rate >= {rules.warn_rate} THEN 'WARN' ELSE 'FAIL' END",
        ),
    ]


def row_flag_checks() -> list[Check]:
    t = "dq_row_level_flags"
    return [
        *_present(t, "affected_row", "dq_checked_at"),
        accepted_values(t, "affected_row", [0, 1]),
        *_bounded(t, ("error_count",), 0, None),
        expression_is_true(t, "error_count_not_negative", "error_count >= 0"),
        expression_is_true(
            t, "affected_row_matches_error_count", "(affected_row = 1) = (error_count > 0)"
        ),
    ]


def usable_checks() -> list[Check]:
    t = "dq_usable_summary"
    percents = tuple(
        f"pct_{p}" for p in ("usable_data", "one_error", "two_to_three_errors", "four_plus_errors")
    )
    share = (
        "round(100 * (CAST(clean_rows AS DECIMAL(18,0))"
        " / CAST(NULLIF(total_rows, 0) AS DECIMAL(18,0))), 2)"
    )
    return [
        *_bounded(t, ("total_rows", "affected_rows", "clean_rows"), 0, None),
        *_bounded(t, percents, 0, 100),
        *_present(
            t, "zero_errors", "min_errors", "max_errors", "data_quality_grade",
            "drop_strategy_recommendation", "computed_at",
        ),
        accepted_values(
            t, "data_quality_grade", [*(label for _, label in GRADES), LOWEST_GRADE]
        ),
        expression_is_true(t, "rows_add_up", "clean_rows + affected_rows = total_rows"),
        expression_is_true(t, "usable_share_recomputes", f"{share} = pct_usable_data"),
    ]


def all_checks(rules: CleanRules | None = None) -> list[Check]:
    """Every declared check; what depends on thresholds follows the given rules."""
    sections = (
        staging_checks(), transaction_checks(), dimension_checks(), fact_checks(),
        completeness_checks(), validity_checks(), uniqueness_checks(), consistency_checks(),
        scorecard_checks(rules or CleanRules()), row_flag_checks(), usable_checks(),
    )
    return [check for section in sections for check in section]
