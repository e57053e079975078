"""Carry-in balances: a customer's totals as of a closed month.

A balance is mergeable: first and last active month, invoices, revenue and last purchase of any
two spans of months add up to those of both. Facts of the open months follow from the balance
and the monthly totals of the open months alone; no window runs over the closed ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillgrain.functions.months import month_of
from tillgrain.operators import rfm
from tillgrain.operators.snapshot import fill_months
from tillgrain.rules import CleanRules

TOTALS = ("txn_count", "total_revenue", "last_invoice_date")
BALANCE = ("customer_id", "first_month", "last_month", *TOTALS)


def of_totals(monthly: DataFrame) -> DataFrame:
    """Monthly totals as balances of one month each; undated ones belong to none."""
    month = F.col("txn_month")
    dated = monthly.where(month.isNotNull())
    return dated.select(
        "customer_id", month.alias("first_month"), month.alias("last_month"), *TOTALS
    )


def merged(*parts: DataFrame) -> DataFrame:
    """One balance per customer over all parts."""
    every = parts[0].select(*BALANCE)
    for part in parts[1:]:
        every = every.unionByName(part.select(*BALANCE))
    return every.groupBy("customer_id").agg(
        F.min("first_month").alias("first_month"),
        F.max("last_month").alias("last_month"),
        F.sum("txn_count").cast("bigint").alias("txn_count"),
        # As wide as the totals, so that balances of balances keep the type.
        F.sum("total_revenue").cast("decimal(38,2)").alias("total_revenue"),
        F.max("last_invoice_date").alias("last_invoice_date"),
    )


def facts_since(
    balance: DataFrame, open_totals: DataFrame, recent: DataFrame, rules: CleanRules, since: Column
) -> DataFrame:
    """Grain and metrics of the snapshots from ``since``, the first open month, on.

    ``balance`` holds the months before ``since``, ``open_totals`` those from then on,
    ``recent`` the snapshots a target has from then on: those that the totals no longer give
    stay, with metrics by the totals of today. Everything is grouped by customer once; a
    balance takes part as one row at the customer's last closed month, which by itself gives no
    open snapshot.
    """
    carried = balance.select(
        "customer_id", F.col("last_month").alias("month"), *TOTALS, "first_month"
    )
    opened = open_totals.where(F.col("txn_month").isNotNull()).select(
        "customer_id",
        F.col("txn_month").alias("month"),
        *TOTALS,
        F.col("txn_month").alias("first_month"),
    )
    running = carried.unionByName(opened).withColumns(rfm.running_totals()).drop(*TOTALS)
    made = fill_months(running, rules, since, "first_month")
    # Snapshots of today, the target's, and the balances that hold for those before any open one.
    closed = carried.select("customer_id", F.col("month").alias("snapshot_date"), *_as_running())
    every = (
        made.withColumn("_kind", F.lit(0))
        .unionByName(closed.withColumn("_kind", F.lit(0)), allowMissingColumns=True)
        .unionByName(
            recent.select(*rfm.GRAIN).withColumn("_kind", F.lit(1)), allowMissingColumns=True
        )
    )
    by_date = Window.partitionBy("customer_id").orderBy("snapshot_date", "_kind")
    held = {
        c: F.last(c, ignorenulls=True).over(by_date) for c in ("_txns", "_revenue", "_last")
    }
    same = F.lag("snapshot_date").over(by_date).eqNullSafe(F.col("snapshot_date"))
    return (
        every.withColumns({**held, "_again": same & (F.col("_kind") == 1)})
        .where(~F.col("_again") & (F.col("snapshot_date") >= since))
        .select(*rfm.GRAIN, *rfm.metrics())
    )


def _as_running() -> list[Column]:
    names = ("_txns", "_revenue", "_last")
    return [F.col(t).alias(n) for t, n in zip(TOTALS, names, strict=True)]


def before(month: Column, totals: DataFrame) -> DataFrame:
    """Balances over the monthly totals before a month."""
    return merged(of_totals(totals.where(F.col("txn_month") < month)))


def totals_of(lines: DataFrame) -> DataFrame:
    """Monthly totals, typed alike whatever lines they come from."""
    return rfm.monthly_transactions(lines).withColumn(
        "total_revenue", F.col("total_revenue").cast("decimal(38,2)")
    )


def month_column(lines: DataFrame) -> DataFrame:
    return lines.withColumn("txn_month", month_of(F.col("invoice_date")))
