"""Incremental runs of the two snapshot facts.

``look_back`` reprocesses the months from one before the target's latest. A
customer who returns after a longer gap then misses the months in between.
``affected_customers`` instead rebuilds every customer whose active months differ from
the target's, new, moved and vanished ones alike, and drops customers without any; this
gives the same rows as a full refresh. The metrics follow the customers whose monthly
totals differ from those stored by the earlier run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillgrain.operators import balances, snapshot
from tillgrain.operators import rfm as rfm_op
from tillgrain.operators.snapshot import look_back_start
from tillgrain.operators.upsert import upsert
from tillgrain.rules import GRAIN_KEY, CleanRules
from tillgrain.sources.tables import merge_into_partitions

MODES = ("look_back", "affected_customers")


def _before(since: Column) -> Column:
    return F.col("snapshot_date") < since


def grain_delta(target: DataFrame, filtered: DataFrame, rules: CleanRules) -> DataFrame:
    """Snapshots from the look-back month on, over the full history."""
    return snapshot.composite_grain(filtered, rules, since=look_back_start(target))


def grain_incremental(
    target: DataFrame, filtered: DataFrame, rules: CleanRules, mode: str = "look_back"
) -> DataFrame:
    """Target after one incremental run over the current transactions."""
    if mode == "look_back":
        delta = grain_delta(target, filtered, rules)
        return upsert(target, delta, GRAIN_KEY, settled=_before(look_back_start(target)))
    if mode == "affected_customers":
        return snapshot.grain_of_affected(target, filtered, rules)
    raise ValueError(f"mode must be one of {MODES}")


def rfm_delta(target: DataFrame, grain: DataFrame, filtered: DataFrame) -> DataFrame:
    """Metrics of the snapshots from the look-back month on."""
    return rfm_op.rfm(grain, filtered, since=look_back_start(target))


def rfm_incremental(target: DataFrame, grain: DataFrame, filtered: DataFrame) -> DataFrame:
    """Target after one incremental run over the current grain and transactions."""
    delta = rfm_delta(target, grain, filtered)
    return upsert(target, delta, GRAIN_KEY, settled=_before(look_back_start(target)))


def facts_incremental(
    metrics: DataFrame, balance: DataFrame, open_totals: DataFrame, rules: CleanRules
) -> DataFrame:
    """RFM, and with it the grain, after a look-back run that reads the open months alone.

    ``balance`` holds all months before the look-back month, ``open_totals`` the monthly totals
    from then on. The rows are those of ``grain_incremental`` and ``rfm_incremental``.
    """
    since = look_back_start(metrics)
    recent = metrics.where(F.col("snapshot_date") >= since)
    delta = balances.facts_since(balance, open_totals, recent, rules, since)
    return metrics.where(_before(since)).unionByName(delta)


def rfm_of_affected(
    target: DataFrame, monthly_before: DataFrame, filtered: DataFrame, rules: CleanRules
) -> DataFrame:
    """Target with every customer rebuilt whose monthly totals changed.

    ``monthly_before`` are the totals that the target was made from. Only the comparison
    reads all months; running totals are taken for changed customers alone.
    """
    totals = ("txn_count", "total_revenue", "last_invoice_date")
    key = ["customer_id", "txn_month"]
    monthly = rfm_op.monthly_transactions(filtered).where("txn_month IS NOT NULL")
    before = monthly_before.where("txn_month IS NOT NULL").select(
        *key, *[F.col(c).alias(f"_{c}") for c in totals]
    )
    equal = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in totals]
    changed = (
        monthly.join(before, key, "full")
        .where(~(equal[0] & equal[1] & equal[2]))
        .select("customer_id")
        .distinct()
    )
    rebuilt = rfm_op.rfm_of_months(monthly.join(changed, "customer_id", "left_semi"), rules)
    return snapshot.replace_customers(target, changed, rebuilt)


def refresh_stored(
    spark: SparkSession, out_dir: str, filtered: DataFrame, rules: CleanRules
) -> tuple[DataFrame, DataFrame]:
    """Look-back run against the stored facts; only the months it touches are rewritten."""
    grain_path, rfm_path = f"{out_dir}/composite_grain", f"{out_dir}/customer_rfm"
    delta = grain_delta(spark.read.parquet(grain_path), filtered, rules)
    grain = merge_into_partitions(spark, grain_path, delta, GRAIN_KEY, "snapshot_date")
    delta = rfm_delta(spark.read.parquet(rfm_path), grain, filtered)
    facts = merge_into_partitions(spark, rfm_path, delta, GRAIN_KEY, "snapshot_date")
    return grain, facts
