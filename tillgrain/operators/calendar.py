"""Month dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillgrain.functions.months import month_index, month_of, months_between
from tillgrain.rules import CleanRules


def _described(months: DataFrame) -> DataFrame:
    month = F.col("month_start")
    return months.select(
        month,
        month_index(month).alias("month_index"),
        F.year(month).alias("year"),
        F.month(month).alias("month_num"),
    )


def month_dimension(spark: SparkSession, rules: CleanRules) -> DataFrame:
    """One row per month in [first_month, end_month)."""
    months = months_between(rules.dim_low(), rules.dim_high())
    return _described(spark.range(1).select(F.explode(months).alias("month_start")))


def with_line_counts(dimension: DataFrame, lines: DataFrame) -> DataFrame:
    """The dimension with the number of lines dated in each month."""
    counted = lines.groupBy(month_of(F.col("invoice_date")).alias("month_start")).agg(
        F.count(F.lit(1)).alias("n_lines")
    )
    return dimension.join(counted, "month_start", "left").fillna(0, ["n_lines"])
