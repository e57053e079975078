"""Cumulative recency, frequency and monetary value per customer-month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillgrain.functions.months import month_of, whole_days
from tillgrain.operators.snapshot import fill_months
from tillgrain.rules import CleanRules


def monthly_transactions(filtered: DataFrame) -> DataFrame:
    """Invoices, revenue and last purchase per known customer and month.

    Cancellations count as invoices. An undated line falls into a NULL month.
    """
    return (
        filtered.where(F.col("customer_id").isNotNull())
        .groupBy("customer_id", month_of(F.col("invoice_date")).alias("txn_month"))
        .agg(
            F.count_distinct("invoice_no").alias("txn_count"),
            F.sum("revenue").alias("total_revenue"),
            F.max("invoice_date").alias("last_invoice_date"),
        )
    )


def _dated_months(filtered: DataFrame) -> DataFrame:
    monthly = monthly_transactions(filtered).withColumnRenamed("txn_month", "month")
    return monthly.where(F.col("month").isNotNull())


def running_totals() -> dict[str, Column]:
    """Totals over all of a customer's months up to and including the current row's."""
    so_far = (
        Window.partitionBy("customer_id")
        .orderBy("month")
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return {
        "_txns": F.sum("txn_count").over(so_far),
        "_revenue": F.sum("total_revenue").over(so_far),
        "_last": F.max("last_invoice_date").over(so_far),
    }


def metrics() -> list[Column]:
    txns = F.col("_txns")
    return [
        F.when(F.col("had_activity"), F.lit(0))
        .otherwise(whole_days(F.col("snapshot_date"), F.col("_last")))
        .alias("recency_days"),
        F.greatest(txns - 1, F.lit(0)).cast("bigint").alias("frequency"),
        F.when(txns > 0, F.col("_revenue").cast("double") / txns).alias("monetary_value"),
    ]


GRAIN = ("customer_id", "snapshot_date", "had_activity", "months_since_first_purchase")


def rfm(grain: DataFrame, filtered: DataFrame, since: Column | None = None) -> DataFrame:
    """Metrics for any snapshot grain, holes included.

    "All transactions up to the snapshot month" is a running window over the
    snapshots and the monthly totals of a customer stacked on each other, at
    most two rows per calendar month, instead of a join that pairs every
    snapshot with every earlier month. ``since`` keeps later snapshots only,
    after the window has seen the full history.
    """
    snapshots = grain.select(*GRAIN, F.col("snapshot_date").alias("month"))
    timeline = snapshots.unionByName(_dated_months(filtered), allowMissingColumns=True)
    out = (
        timeline.withColumns(running_totals())
        .where(F.col("snapshot_date").isNotNull())
        .select(*GRAIN, *metrics())
    )
    return out if since is None else out.where(F.col("snapshot_date") >= since)


def rfm_full_refresh(filtered: DataFrame, rules: CleanRules) -> DataFrame:
    """Grain and metrics in one pass over the transactions.

    Same rows as ``rfm(composite_grain(filtered), filtered)``: the monthly
    totals already hold the active months, so the running totals are taken over
    them and carried into the inactive months that follow.
    """
    return rfm_of_months(monthly_transactions(filtered), rules)


def rfm_of_months(monthly: DataFrame, rules: CleanRules) -> DataFrame:
    """The same from monthly totals."""
    dated = monthly.withColumnRenamed("txn_month", "month").where(F.col("month").isNotNull())
    running = dated.withColumns(running_totals())
    carried = running.drop("txn_count", "total_revenue", "last_invoice_date")
    return fill_months(carried, rules).select(*GRAIN, *metrics())
