"""The definitions written down word for word: slow, used to cross-check and to time."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillgrain.functions.months import whole_days
from tillgrain.operators import quality, rfm, rowflags, snapshot
from tillgrain.operators.dedup import RAW_TIE_BREAK
from tillgrain.rules import ROW_KEY


def literal_grain(filtered, dim, activity):
    """Range join against the dimension, then the joins for tenure and activity."""
    base = snapshot.customer_bounds(filtered)
    spine = base.join(dim, F.col("month_start").between(F.col("first_month"), F.col("last_month")))
    first = base.join(dim, F.col("month_start") == F.col("first_month")).select(
        "customer_id", F.col("month_index").alias("first_index")
    )
    active = activity.select(
        "customer_id", F.col("activity_month").alias("month_start"), F.lit(True).alias("a")
    )
    return (
        spine.join(first, "customer_id")
        .join(active, ["customer_id", "month_start"], "left")
        .select(
            "customer_id",
            F.col("month_start").alias("snapshot_date"),
            F.col("a").isNotNull().alias("had_activity"),
            (F.col("month_index") - F.col("first_index") + 1).alias(
                "months_since_first_purchase"
            ),
        )
    )


def literal_rfm(grain, filtered):
    """Every snapshot joined with all earlier months of the customer."""
    m = rfm.monthly_transactions(filtered)
    g = grain.alias("g")
    condition = (F.col("g.customer_id") == m.customer_id) & (
        m.txn_month <= F.col("g.snapshot_date")
    )
    keys = [f"g.{c}" for c in rfm.GRAIN]
    total = (
        g.join(m, condition, "left")
        .groupBy(*keys)
        .agg(
            F.max("last_invoice_date").alias("last"),
            F.sum("txn_count").alias("n"),
            F.sum("total_revenue").alias("v"),
        )
    )
    return total.select(
        *rfm.GRAIN,
        F.when(F.col("had_activity"), 0)
        .otherwise(whole_days(F.col("snapshot_date"), F.col("last")))
        .alias("recency_days"),
        F.greatest(F.col("n") - 1, F.lit(0)).alias("frequency"),
        F.when(F.col("n") > 0, F.col("v").cast("double") / F.col("n")).alias("monetary_value"),
    )


def literal_row_flags(raw, rules):
    """Global row numbers, one table of flags per dimension, joined on the number."""
    order = [F.col(c).asc_nulls_last() for c in rowflags.ROW_ORDER]
    numbered = raw.withColumn("row_id", F.row_number().over(Window.orderBy(*order)))
    own = rowflags.row_flags(rules)
    groups = ("incomplete", "invalid", "inconsistent")
    parts = [
        numbered.select("row_id", *[f.alias(n) for n, f in own.items() if n.startswith(g)])
        for g in groups
    ]
    within = [F.col(c).asc_nulls_last() for c in ("invoice_date", *RAW_TIE_BREAK)]
    rank = F.row_number().over(Window.partitionBy(*ROW_KEY).orderBy(*within))
    parts.append(
        numbered.select("row_id", F.when(rank > 1, 1).otherwise(0).alias("is_duplicate"))
    )
    joined = reduce(lambda a, b: a.join(b, "row_id", "left"), parts, numbered)
    errors = sum((F.col(n) for n in (*own, "is_duplicate")), F.lit(0))
    return joined.select(
        *rowflags.OUTPUT_COLUMNS,
        F.when(errors > 0, 1).otherwise(0).alias("affected_row"),
        errors.alias("error_count"),
    )


def literal_metric_sections(raw, rules):
    """The four metric tables, each from its own scan, one SELECT per metric."""
    from tillgrain.functions import flags

    tables = {
        quality.completeness(raw): [
            (f"{c}_incomplete_count", f"{c}_completeness_rate")
            for c in flags.COMPLETENESS_COLUMNS
        ] + [("fully_complete_row_count", "fully_complete_row_rate"),
             ("incomplete_row_count", "1 - fully_complete_row_rate")],
        quality.validity(raw, rules): [
            (f"{c}_invalid_count", f"{c}_validity_rate") for c in flags.VALIDITY_COLUMNS
        ] + [("fully_valid_row_count", "fully_valid_row_rate"),
             ("invalid_row_count", "1 - fully_valid_row_rate")],
        quality.uniqueness(raw): [
            (f"composite_duplicate_{n}_count", "composite_uniqueness_rate")
            for n in ("group", "row")
        ],
        quality.consistency(raw): [
            ("sale_with_zero_price_count", "sales_price_consistency_rate"),
            ("return_with_nonpositive_price_count", "return_price_consistency_rate"),
        ],
    }
    rows = [
        df.selectExpr(
            f"'{v}' AS metric", f"CAST({v} AS BIGINT) AS metric_value",
            f"CAST({r} AS DECIMAL(5,4)) AS rate",
        )
        for df, metrics in tables.items()
        for v, r in metrics
    ]
    return reduce(DataFrame.unionByName, rows)
