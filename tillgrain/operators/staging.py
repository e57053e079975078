"""Cleaning chain: raw lines -> staged -> enriched -> filtered.

Everything here is a projection or a filter: no shuffle, one codegen stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillgrain.functions.flags import country_invalid
from tillgrain.rules import CleanRules


def stage(raw: DataFrame, rules: CleanRules) -> DataFrame:
    """Trim the text keys, fix the types, flag unlisted countries.

    Quantities round half to even. Description and load time are not carried on.
    """
    country = F.trim("country")
    return raw.select(
        F.trim("invoice_no").alias("invoice_no"),
        F.trim("stock_code").alias("stock_code"),
        F.rint("quantity").cast("int").alias("quantity"),
        F.col("unit_price").cast("decimal(10,2)").alias("unit_price"),
        F.col("invoice_date").cast("timestamp_ntz").alias("invoice_date"),
        F.trim("customer_id").alias("customer_id"),
        country.alias("country"),
        country_invalid(country, country, rules).alias("country_invalid"),
    )


def enrich(lines: DataFrame) -> DataFrame:
    """Add revenue; returns are negative."""
    return lines.withColumn("revenue", F.col("quantity") * F.col("unit_price"))


def keep_logical(lines: DataFrame) -> DataFrame:
    """Drop sales with a negative price.

    A negative price with an unknown quantity is dropped too: the condition is
    then unknown, and only rows where it holds are kept.
    """
    return lines.where(~((F.col("quantity") > 0) & (F.col("unit_price") < 0)))
