"""How much of the raw table can be used, and what to do about the rest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillgrain.functions.flags import flag
from tillgrain.functions.rates import banded, percent
from tillgrain.rules import DROP_STRATEGIES, GRADES, LAST_DROP_STRATEGY, LOWEST_GRADE


def error_statistics(row_flags: DataFrame) -> DataFrame:
    errors, affected = F.col("error_count"), F.col("affected_row")

    def rows(condition: Column) -> Column:
        return F.sum(flag(condition))  # NULL on an empty table

    return row_flags.agg(
        F.count(F.lit(1)).alias("total_rows"),
        rows(affected == 1).alias("affected_rows"),
        rows(affected == 0).alias("clean_rows"),
        rows(errors == 0).alias("zero_errors"),
        rows(errors == 1).alias("one_error"),
        rows(errors.between(2, 3)).alias("two_to_three_errors"),
        rows(errors >= 4).alias("four_plus_errors"),
        F.avg(F.when(affected == 1, errors)).alias("avg_errors_per_affected_row"),
        F.min(errors).alias("min_errors"),
        F.max(errors).alias("max_errors"),
    )


def _insight(usable: Column) -> Column:
    affected = F.col("affected_rows").cast("string")
    loss = F.round(100 - usable, 1).cast("string")
    # Fixed texts; concat_ws leaves unknown values out.
    return (
        F.when(
            usable >= 95,
            F.concat_ws(
                "", F.lit("Safe to filter out "), affected, F.lit(" invalid rows ("),
                loss, F.lit("% loss)"),
            ),
        )
        .when(
            usable >= 85,
            F.concat_ws(
                "", F.lit("Review "), affected, F.lit(" affected rows before dropping ("),
                loss, F.lit("% loss)"),
            ),
        )
        .otherwise(
            F.concat_ws(
                "", F.lit("Critical: Only "), usable.cast("string"),
                F.lit("% usable - Investigate root causes"),
            )
        )
    )


def usable_summary(row_flags: DataFrame, computed_at: Column | None = None) -> DataFrame:
    """One row of counts, shares, grade and advice."""
    total, usable = F.col("total_rows"), F.col("pct_usable_data")
    shares = {
        "pct_usable_data": "clean_rows",
        "pct_one_error": "one_error",
        "pct_two_to_three_errors": "two_to_three_errors",
        "pct_four_plus_errors": "four_plus_errors",
    }
    measured = error_statistics(row_flags).withColumns(
        {name: percent(F.col(count), total) for name, count in shares.items()}
    )
    return measured.select(
        "total_rows",
        "affected_rows",
        "clean_rows",
        "pct_usable_data",
        "zero_errors",
        "pct_one_error",
        "pct_two_to_three_errors",
        "pct_four_plus_errors",
        "avg_errors_per_affected_row",
        "min_errors",
        "max_errors",
        banded(usable, GRADES, LOWEST_GRADE).alias("data_quality_grade"),
        banded(usable, DROP_STRATEGIES, LAST_DROP_STRATEGY).alias(
            "drop_strategy_recommendation"
        ),
        _insight(usable).alias("actionable_insight"),
        (F.current_timestamp() if computed_at is None else computed_at).alias("computed_at"),
    )
