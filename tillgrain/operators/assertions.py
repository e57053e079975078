"""The named invariants of the tables: each yields the rows that violate it.

``violations(id)`` returns those rows, ``outcome(id)`` their number. A row that
violates a combined invariant in several ways appears once per way.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillgrain import rules as R
from tillgrain.functions.months import month_index, month_of
from tillgrain.functions.rates import percent
from tillgrain.operators.checks import Tables
from tillgrain.rules import ROW_KEY, CleanRules

Finder = Callable[[Tables, CleanRules], DataFrame]


@dataclass(frozen=True)
class Assertion:
    id: str
    name: str
    find: Finder


ASSERTIONS: dict[str, Assertion] = {}


def _assertion(id: str, name: str) -> Callable[[Finder], Finder]:
    def register(find: Finder) -> Finder:
        ASSERTIONS[id] = Assertion(id, name, find)
        return find

    return register


def violations(id: str, tables: Tables, rules: CleanRules) -> DataFrame:
    return ASSERTIONS[id].find(tables, rules)


def outcome(id: str, tables: Tables, rules: CleanRules) -> DataFrame:
    """One row (check_name, failing_rows)."""
    found = violations(id, tables, rules)
    return found.agg(
        F.lit(f"{id}_{ASSERTIONS[id].name}").alias("check_name"),
        F.count(F.lit(1)).alias("failing_rows"),
    )


def _each_failure(df: DataFrame, failures: dict[str, Column]) -> DataFrame:
    """One row per failed condition, from a single pass."""
    found = F.array(*[F.when(broken, F.lit(name)) for name, broken in failures.items()])
    return df.withColumn("failure_type", F.explode(F.array_compact(found)))


# -- staging -----------------------------------------------------------------


@_assertion("a1", "invalid_country_is_flagged")
def _(tables: Tables, rules: CleanRules) -> DataFrame:
    country = F.col("country")
    bad = ~country.rlike(R.COUNTRY_PATTERN) | ~country.isin(*rules.countries)
    return tables["stg_cleaned"].where(bad & (F.col("country_invalid") == 0))


@_assertion("a2", "valid_country_is_not_flagged")
def _(tables: Tables, rules: CleanRules) -> DataFrame:
    country = F.col("country")
    good = country.isin(*rules.countries) & country.rlike(R.COUNTRY_PATTERN)
    return tables["stg_cleaned"].where(good & (F.col("country_invalid") == 1))


@_assertion("a3", "staged_text_is_trimmed")
def _(tables: Tables, rules: CleanRules) -> DataFrame:
    return tables["stg_cleaned"].where(
        " OR ".join(
            f"{c} <> trim({c})" for c in ("invoice_no", "stock_code", "customer_id", "country")
        )
    )


@_assertion("a4", "staged_numbers_and_dates_are_present")
def _(tables: Tables, rules: CleanRules) -> DataFrame:
    return tables["stg_cleaned"].where(
        "quantity IS NULL OR unit_price IS NULL OR invoice_date IS NULL"
    )


# -- cleaning chain ----------------------------------------------------------

REQUIRED_AFTER_DEDUP = (
    "invoice_no",
    "stock_code",
    "quantity",
    "unit_price",
    "invoice_date",
    "country",
    "country_invalid",
    "rn",
)


@_assertion("a5", "deduplicated_rows_are_sound")
def _(tables: Tables, rules: CleanRules) -> DataFrame:
    rows = tables["txn_deduplicated"]
    missing = F.expr(" OR ".join(f"{c} IS NULL" for c in REQUIRED_AFTER_DEDUP))
    off_list = ~F.col("country_invalid").isin(0, 1) | (F.col("rn") != 1)
    found = _each_failure(rows, {"not_null": missing, "accepted_values": off_list})
    repeated = (
        rows.groupBy(*ROW_KEY)
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
        .select(*ROW_KEY, F.lit("duplicate_key").alias("failure_type"))
    )
    return found.unionByName(repeated, allowMissingColumns=True)


@_assertion("a6", "revenue_is_quantity_times_price")
def _(tables: Tables, rules: CleanRules) -> DataFrame:
    rows = tables["txn_enriched"]
    revenue = F.col("revenue")
    off = F.abs(revenue - F.col("quantity") * F.col("unit_price")) > F.lit(0.0001)
    found = _each_failure(
        rows, {"not_null_revenue": revenue.isNull(), "invalid_revenue_calculation": off}
    )
    none_at_all = rows.where(~rows.where(revenue.isNotNull()).exists()).withColumn(
        "failure_type", F.lit("no_revenue_present")
    )
    return found.unionByName(none_at_all)


@_assertion("a7", "no_sale_has_a_negative_price")
def _(tables: Tables, rules: CleanRules) -> DataFrame:
    return tables["txn_filtered"].where("quantity > 0 AND unit_price < 0")


@_assertion("a8", "no_activity_after_last_transaction")
def _(tables: Tables, rules: CleanRules) -> DataFrame:
    last = (
        tables["txn_filtered"]
        .groupBy("customer_id")
        .agg(month_of(F.max("invoice_date")).alias("max_activity_month"))
    )
    return (
        tables["customer_activity_months"]
        .join(last, "customer_id")
        .where(F.col("activity_month") > F.col("max_activity_month"))
    )


@_assertion("a9", "activity_has_transactions")
def _(tables: Tables, rules: CleanRules) -> DataFrame:
    traded = (
        tables["txn_filtered"]
        .select("customer_id", month_of(F.col("invoice_date")).alias("activity_month"))
        .distinct()
    )
    return tables["customer_activity_months"].join(
        traded, ["customer_id", "activity_month"], "left_anti"
    )


# -- month dimension ---------------------------------------------------------


@_assertion("a10", "months_span_the_configured_bounds")
def _(tables: Tables, rules: CleanRules) -> DataFrame:
    return (
        tables["dim_months"]
        .agg(F.min("month_start").alias("low"), F.max("month_start").alias("high"))
        .where((F.col("low") != rules.dim_low()) | (F.col("high") != rules.dim_high()))
    )


@_assertion("a11", "months_are_contiguous")
def _(tables: Tables, rules: CleanRules) -> DataFrame:
    # One row per calendar month: the ordered window stays within one small task.
    earlier = F.lag("month_start").over(Window.orderBy("month_start"))
    return (
        tables["dim_months"]
        .withColumn("previous", earlier)
        .where(F.col("month_start") != F.add_months(F.col("previous"), 1))
    )


@_assertion("a12", "month_index_follows_the_formula")
def _(tables: Tables, rules: CleanRules) -> DataFrame:
    return tables["dim_months"].where(
        F.col("month_index") != month_index(F.col("month_start"))
    )


# -- snapshot facts ----------------------------------------------------------


def _with_previous(df: DataFrame, column: str) -> DataFrame:
    """Value of the customer's preceding snapshot as ``previous``."""
    by_snapshot = Window.partitionBy("customer_id").orderBy(F.col("snapshot_date").asc_nulls_last())
    return df.withColumn("previous", F.lag(column).over(by_snapshot))


@_assertion("a13", "activity_flag_matches_activity_months")
def _(tables: Tables, rules: CleanRules) -> DataFrame:
    active = tables["customer_activity_months"].select(
        "customer_id",
        F.col("activity_month").alias("snapshot_date"),
        F.lit(True).alias("traded"),
    )
    return (
        tables["composite_grain"]
        .join(active, ["customer_id", "snapshot_date"], "left")
        .where(F.col("had_activity") != F.coalesce("traded", F.lit(False)))
    )


@_assertion("a14", "tenure_strictly_increases")
def _(tables: Tables, rules: CleanRules) -> DataFrame:
    return _with_previous(tables["composite_grain"], "months_since_first_purchase").where(
        "months_since_first_purchase <= previous"
    )


@_assertion("a15", "no_snapshot_in_the_future")
def _(tables: Tables, rules: CleanRules) -> DataFrame:
    return tables["composite_grain"].where(F.col("snapshot_date") > rules.now().cast("date"))


@_assertion("a16", "no_month_is_missing")
def _(tables: Tables, rules: CleanRules) -> DataFrame:
    return _with_previous(tables["composite_grain"], "snapshot_date").where(
        "snapshot_date <> add_months(previous, 1)"
    )


@_assertion("a17", "active_month_has_zero_recency")
def _(tables: Tables, rules: CleanRules) -> DataFrame:
    return tables["customer_rfm"].where(
        F.col("had_activity") & ~F.col("recency_days").eqNullSafe(0)
    )


@_assertion("a18", "monetary_value_implies_recency")
def _(tables: Tables, rules: CleanRules) -> DataFrame:
    return tables["customer_rfm"].where("monetary_value IS NOT NULL AND recency_days IS NULL")


@_assertion("a19", "recency_is_not_negative")
def _(tables: Tables, rules: CleanRules) -> DataFrame:
    return tables["customer_rfm"].where("recency_days < 0")


@_assertion("a20", "recency_does_not_fall_while_inactive")
def _(tables: Tables, rules: CleanRules) -> DataFrame:
    return _with_previous(tables["customer_rfm"], "recency_days").where(
        "NOT had_activity AND recency_days < previous"
    )


@_assertion("a21", "inactive_month_has_recency")
def _(tables: Tables, rules: CleanRules) -> DataFrame:
    return tables["customer_rfm"].where("recency_days IS NULL AND NOT had_activity")


@_assertion("a22", "snapshots_strictly_increase")
def _(tables: Tables, rules: CleanRules) -> DataFrame:
    return _with_previous(tables["customer_rfm"], "snapshot_date").where(
        "snapshot_date <= previous"
    )


# -- row flags and usable data -----------------------------------------------


@_assertion("a23", "affected_row_matches_error_count")
def _(tables: Tables, rules: CleanRules) -> DataFrame:
    return tables["dq_row_level_flags"].where(
        "(affected_row = 0 AND error_count > 0) OR (affected_row = 1 AND error_count = 0)"
    )


@_assertion("a24", "error_count_is_not_negative")
def _(tables: Tables, rules: CleanRules) -> DataFrame:
    return tables["dq_row_level_flags"].where("error_count < 0")


@_assertion("a25", "usable_share_recomputes")
def _(tables: Tables, rules: CleanRules) -> DataFrame:
    share = percent(F.col("clean_rows"), F.col("total_rows"))
    return tables["dq_usable_summary"].where(share != F.col("pct_usable_data"))


@_assertion("a26", "clean_and_affected_add_up")
def _(tables: Tables, rules: CleanRules) -> DataFrame:
    return tables["dq_usable_summary"].where("clean_rows + affected_rows <> total_rows")


# -- scorecard ---------------------------------------------------------------


@_assertion("a27", "all_dimensions_are_present")
def _(tables: Tables, rules: CleanRules) -> DataFrame:
    return (
        tables["dq_summary"]
        .agg(F.count_distinct("dimension").alias("dimensions"))
        .where("dimensions <> 5")
    )


SECTION_ROWS = {
    "a28": ("completeness", 10),
    "a29": ("validity", 9),
    "a30": ("uniqueness", 2),
    "a31": ("consistency", 2),
    "a32": ("overall", 1),
}


def _section_has(dimension: str, expected: int) -> Finder:
    def find(tables: Tables, rules: CleanRules) -> DataFrame:
        rows = F.count_if(F.col("dimension") == dimension)
        return tables["dq_summary"].agg(rows.alias("rows")).where(F.col("rows") != expected)

    return find


for _id, (_dimension, _rows) in SECTION_ROWS.items():
    _assertion(_id, f"{_dimension}_section_row_count")(_section_has(_dimension, _rows))


@_assertion("a33", "overall_score_is_the_mean_rate")
def _(tables: Tables, rules: CleanRules) -> DataFrame:
    overall = F.col("dimension") == "overall"
    return (
        tables["dq_summary"]
        .agg(
            F.avg(F.when(~overall, F.col("rate"))).alias("avg_rate"),
            F.max(F.when(overall, F.col("rate"))).alias("overall_rate"),
        )
        .where(F.abs(F.col("avg_rate") - F.col("overall_rate")) > F.lit(0.0001))
    )
