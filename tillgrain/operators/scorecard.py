"""Quality scorecard: every metric of the four dimensions as one long table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillgrain.functions import flags
from tillgrain.functions.rates import RATE, banded, complement_share, share
from tillgrain.operators import quality
from tillgrain.rules import (
    COMPOSITE_KEY_NAME,
    RETURN_RULE_NAME,
    SALE_RULE_NAME,
    CleanRules,
)

ALL_COLUMNS = "ALL_COLUMNS"
LABELS = ("dimension", "check_name", "metric_name")


# How a metric's rate follows from its part and whole.
GOOD_SHARE = "good"  # part of the whole that is fine
BAD_SHARE = "bad"  # part of the whole that is not; the rate is what remains
REST_OF_GOOD = "rest"  # what the rounded good share leaves


def _metric(
    dimension: str, check: str, metric: str, value: str, part: str, whole: str, form: str
) -> str:
    return (
        f"struct('{dimension}' AS dimension, '{check}' AS check_name,"
        f" '{metric}' AS metric_name, {value} AS metric_value,"
        f" {part} AS part, {whole} AS whole, '{form}' AS form, n_total)"
    )


def _as_rows(metrics: list[str]) -> Column:
    return F.expr(f"inline(array({', '.join(metrics)}))")


def _rate() -> Column:
    part, whole, form = F.col("part"), F.col("whole"), F.col("form")
    return (
        F.when(form == BAD_SHARE, complement_share(part, whole))
        .when(form == GOOD_SHARE, share(part, whole))
        .otherwise((1 - share(part, whole)).cast(RATE))
    )


def _whole_row_metrics(dimension: str, good: str, bad: str) -> list[str]:
    return [
        _metric(dimension, ALL_COLUMNS, good, good, good, "n_total", GOOD_SHARE),
        _metric(dimension, ALL_COLUMNS, bad, bad, good, "n_total", REST_OF_GOOD),
    ]


def _failures(dimension: str, check: str, metric: str, count: str, whole: str) -> str:
    return _metric(dimension, check, metric, count, count, whole, BAD_SHARE)


def _scan_metrics() -> list[str]:
    """Completeness, validity and consistency: all from one aggregate row."""
    return [
        *[
            _failures("completeness", c, "incomplete_count", f"{c}_incomplete_count", "n_total")
            for c in flags.COMPLETENESS_COLUMNS
        ],
        *_whole_row_metrics(
            "completeness", "fully_complete_row_count", "incomplete_row_count"
        ),
        *[
            _failures("validity", c, "invalid_count", f"{c}_invalid_count", "n_total")
            for c in flags.VALIDITY_COLUMNS
        ],
        *_whole_row_metrics("validity", "fully_valid_row_count", "invalid_row_count"),
        *[
            _failures("consistency", rule, "failing_row_count", count, whole)
            for rule, count, whole in (
                (SALE_RULE_NAME, "sale_with_zero_price_count", "total_sale_rows"),
                (
                    RETURN_RULE_NAME,
                    "return_with_nonpositive_price_count",
                    "total_return_rows",
                ),
            )
        ],
    ]


def _key_metrics() -> list[str]:
    extra = "composite_duplicate_row_count"
    return [
        _metric(
            "uniqueness", COMPOSITE_KEY_NAME, metric, f"composite_{metric}",
            extra, "n_total", BAD_SHARE,
        )
        for metric in ("duplicate_group_count", "duplicate_row_count")
    ]


def metric_rows(
    raw: DataFrame,
    rules: CleanRules,
    key_counts: DataFrame | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """The 23 metrics: one scan for three dimensions, one key shuffle for uniqueness, which
    ``counts`` (``quality.scanned_counts``) and ``key_counts`` (``quality.uniqueness_counts``)
    save where they are known."""
    if counts is None:
        counts = quality.scanned_counts(raw, rules)
    total = F.col("n_total")
    rest = {
        "incomplete_row_count": total - F.col("fully_complete_row_count"),
        "invalid_row_count": total - F.col("fully_valid_row_count"),
    }
    scanned = counts.withColumns(rest).select(_as_rows(_scan_metrics()))
    if key_counts is None:
        key_counts = quality.uniqueness_counts(raw)
    keyed = key_counts.select(_as_rows(_key_metrics()))
    # An empty table has no completeness and no validity.
    meaningful = F.col("dimension").isin("uniqueness", "consistency") | (total > 0)
    return (
        scanned.unionByName(keyed)
        .where(meaningful)
        .select(*LABELS, "metric_value", _rate().alias("rate"), "n_total")
    )


def status(rate: Column, rules: CleanRules) -> Column:
    bands = tuple(
        (F.lit(bound).cast(RATE), label)
        for bound, label in ((rules.pass_rate, "PASS"), (rules.warn_rate, "WARN"))
    )
    return banded(rate, bands, "FAIL")


def _overall() -> list[Column]:
    """Aggregates that describe one metric, or all of them as a whole."""
    total = F.grouping("dimension") == 1
    rows = F.when(F.col("dimension") == "completeness", F.col("n_total"))
    return [
        total.alias("_is_overall"),
        F.when(~total, F.max("metric_value")).alias("metric_value"),
        F.round(F.avg("rate"), 4).cast(RATE).alias("rate"),
        F.when(total, F.max("_table_rows")).otherwise(F.max("n_total")).alias("n_total"),
        rows.alias("_table_rows"),
    ]


def scorecard(
    raw: DataFrame,
    rules: CleanRules,
    run_at: Column | None = None,
    key_counts: DataFrame | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """24 rows: the metrics and their mean rate as the overall score.

    Grouping sets give the metrics and the grand total from one pass over the
    23 rows, so the raw table is not scanned again for the score.
    """
    *aggregates, table_rows = _overall()
    rows = metric_rows(raw, rules, key_counts, counts).withColumn("_table_rows", table_rows)
    labels = [F.col(c) for c in LABELS]
    overall = F.col("_is_overall")
    scored = rows.groupingSets([labels, []], *labels).agg(*aggregates)
    return scored.where(~overall | F.col("n_total").isNotNull()).select(
        *[
            F.when(overall, F.lit(name)).otherwise(F.col(c)).alias(c)
            for c, name in zip(LABELS, ("overall", "ALL", "dq_score"), strict=True)
        ],
        "metric_value",
        "rate",
        "n_total",
        status(F.col("rate"), rules).alias("status"),
        (F.current_timestamp() if run_at is None else run_at).alias("run_at"),
    )


def overall_score(raw: DataFrame, rules: CleanRules) -> DataFrame:
    """The mean of the 23 rates, unknown ones left out."""
    return metric_rows(raw, rules).agg(
        F.round(F.avg("rate"), 4).cast(RATE).alias("avg_rate")
    )


def export_rows(card: DataFrame) -> DataFrame:
    """The six reported columns in reading order."""
    return card.select(*LABELS, "metric_value", "rate", "n_total").orderBy(*LABELS)
