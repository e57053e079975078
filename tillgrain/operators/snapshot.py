"""Customer-by-month snapshot fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillgrain.functions.months import month_index, month_of, months_between
from tillgrain.rules import CleanRules

LOOK_BACK_MONTHS = 1


def customer_bounds(filtered: DataFrame) -> DataFrame:
    """First and last purchase month of each known customer."""
    return (
        filtered.where(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            month_of(F.min("invoice_date")).alias("first_month"),
            month_of(F.max("invoice_date")).alias("last_month"),
        )
    )


def activity_months(filtered: DataFrame) -> DataFrame:
    """Distinct customer-months with a transaction; an undated one gives a NULL month."""
    return (
        filtered.where(F.col("customer_id").isNotNull())
        .select("customer_id", month_of(F.col("invoice_date")).alias("activity_month"))
        .distinct()
    )


def month_spine(bounds: DataFrame, rules: CleanRules, since: Column | None = None) -> DataFrame:
    """All dimension months between a customer's bounds.

    The range condition against the dimension is a generated sequence: no join.
    """
    floor = [rules.dim_low()] + ([since] if since is not None else [])
    clipped = bounds.select(
        "customer_id",
        "first_month",
        F.greatest(F.col("first_month"), *floor).alias("_low"),
        F.least(F.col("last_month"), rules.dim_high()).alias("_high"),
    ).where(F.col("first_month").isNotNull() & (F.col("_low") <= F.col("_high")))
    return clipped.select(
        "customer_id",
        F.explode(months_between(F.col("_low"), F.col("_high"))).alias("snapshot_date"),
        "first_month",
    ).withColumn("snapshot_month_index", month_index(F.col("snapshot_date")))


def first_month_index(bounds: DataFrame, rules: CleanRules) -> DataFrame:
    """Month index of the first purchase; customers starting outside the dimension drop out."""
    return bounds.where(
        F.col("first_month").between(rules.dim_low(), rules.dim_high())
    ).select("customer_id", month_index(F.col("first_month")).alias("first_month_index"))


def fill_months(
    active: DataFrame, rules: CleanRules, since: Column | None = None, first: str = "month"
) -> DataFrame:
    """Extend each active customer-month over the inactive months that follow it.

    ``active`` has one row per (customer_id, month). The result has one row per
    customer and dimension month from the first to the last active one, with the
    other columns carried forward from the latest active month. One window over
    customer-months replaces the spine, its range join and the activity join; a
    customer has at most one row per calendar month, so no partition can grow
    with the transaction volume. ``first`` names a column whose least value is the
    customer's first month, where ``active`` does not begin with it.
    """
    by_month = Window.partitionBy("customer_id").orderBy("month")
    spanned = (
        active.where(F.col("month").isNotNull())
        .withColumn("_first", F.min(first).over(by_month))
        .withColumn("_next", F.lead("month").over(by_month))
        .where(F.col("_first").between(rules.dim_low(), rules.dim_high()))
    )
    low = F.col("month") if since is None else F.greatest(F.col("month"), since)
    high = F.least(
        F.coalesce(F.add_months(F.col("_next"), -1), F.col("month")), rules.dim_high()
    )
    clipped = (
        spanned.withColumn("_low", low)
        .withColumn("_high", high)
        .where(F.col("_low") <= F.col("_high"))
    )
    carried = [c for c in active.columns if c not in ("customer_id", "month", first)]
    return clipped.select(
        "customer_id",
        F.explode(months_between(F.col("_low"), F.col("_high"))).alias("snapshot_date"),
        "month",
        "_first",
        *carried,
    ).select(
        "customer_id",
        "snapshot_date",
        (F.col("snapshot_date") == F.col("month")).alias("had_activity"),
        (month_index(F.col("snapshot_date")) - month_index(F.col("_first")) + 1)
        .cast("int")
        .alias("months_since_first_purchase"),
        *carried,
    )


def composite_grain(
    filtered: DataFrame, rules: CleanRules, since: Column | None = None
) -> DataFrame:
    """One row per customer and month of the customer's active span.

    Months after the last purchase are not generated. ``since`` keeps only
    snapshots from that month on, computed over the full history.
    """
    return grain_of_activity(activity_months(filtered), rules, since)


def grain_of_activity(
    active: DataFrame, rules: CleanRules, since: Column | None = None
) -> DataFrame:
    return fill_months(active.withColumnRenamed("activity_month", "month"), rules, since)


def look_back_start(target: DataFrame) -> Column:
    """First month an incremental run reprocesses, as a scalar subquery."""
    latest = F.coalesce(F.max("snapshot_date"), F.lit("1900-01-01").cast("date"))
    return target.agg(F.add_months(latest, -LOOK_BACK_MONTHS).alias("since")).scalar()


def outdated_customers(
    target: DataFrame, active: DataFrame, rules: CleanRules
) -> DataFrame:
    """Customers whose snapshots in the target are not those of the activity months.

    Both sides shrink to one row per customer: span and set of active months. They are
    compared in full, so that months which moved or vanished count like new ones, and
    customers without any snapshot left as well. A customer has at most one activity row
    per calendar month.
    """
    low, high = rules.dim_low(), rules.dim_high()
    within = F.when(F.col("activity_month") <= high, F.col("activity_month"))
    expected = (
        active.where(F.col("activity_month").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.min("activity_month").alias("first"),
            F.least(F.max("activity_month"), high).alias("last"),
            F.sort_array(F.collect_set(within)).alias("months"),
        )
        .where(F.col("first").between(low, high))
    )
    known = target.groupBy("customer_id").agg(
        F.min("snapshot_date").alias("known_first"),
        F.max("snapshot_date").alias("known_last"),
        F.sort_array(
            F.collect_set(F.when(F.col("had_activity"), F.col("snapshot_date")))
        ).alias("known_months"),
    )
    same = (
        F.col("first").eqNullSafe(F.col("known_first"))
        & F.col("last").eqNullSafe(F.col("known_last"))
        & F.col("months").eqNullSafe(F.col("known_months"))
    )
    return expected.join(known, "customer_id", "full").where(~same).select("customer_id")


def replace_customers(target: DataFrame, customers: DataFrame, rebuilt: DataFrame) -> DataFrame:
    """The target with all rows of these customers replaced by the rebuilt ones, if any."""
    kept = target.join(customers, "customer_id", "left_anti")
    return kept.unionByName(rebuilt.select(*target.columns))


def grain_of_affected(target: DataFrame, filtered: DataFrame, rules: CleanRules) -> DataFrame:
    """The target with every customer rebuilt whose snapshots are out of date."""
    active = activity_months(filtered)
    affected = outdated_customers(target, active, rules)
    rebuilt = grain_of_activity(active.join(affected, "customer_id", "left_semi"), rules)
    return replace_customers(target, affected, rebuilt)
