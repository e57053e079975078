"""The tables of the system and how they are built from the raw lines."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tillgrain.operators import (
    calendar,
    dedup,
    quality,
    rfm,
    rowflags,
    scorecard,
    snapshot,
    staging,
    usable,
)
from tillgrain.rules import CleanRules
from tillgrain.sources.tables import write_table


@dataclass(frozen=True)
class Lakehouse(Mapping):
    """Every table as a lazy DataFrame over one raw table.

    Works as a mapping from table name to DataFrame. A table is planned when it is
    first asked for, and one that is used alone reads only the columns it needs.
    Deduplicated lines and row flags run jobs while planning: the repeated keys.
    """

    spark: SparkSession
    raw: DataFrame
    rules: CleanRules = field(default_factory=CleanRules)

    NAMES = (
        "stg_cleaned",
        "txn_deduplicated",
        "txn_enriched",
        "txn_filtered",
        "customer_activity_months",
        "dim_months",
        "composite_grain",
        "customer_rfm",
        "dq_completeness",
        "dq_validity",
        "dq_uniqueness",
        "dq_consistency",
        "dq_summary",
        "dq_row_level_flags",
        "dq_usable_summary",
    )

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.NAMES:
            raise KeyError(name)
        return getattr(self, name)

    def __iter__(self):
        return iter(self.NAMES)

    def __len__(self) -> int:
        return len(self.NAMES)

    @cached_property
    def by_key(self) -> dedup.ByKey:
        """The raw lines by whether their key occurs again: counted once for all that ask."""
        return dedup.by_key(self.raw)

    @cached_property
    def stg_cleaned(self) -> DataFrame:
        return staging.stage(self.raw, self.rules)

    @cached_property
    def txn_deduplicated(self) -> DataFrame:
        return dedup.keep_latest_by_key(
            self.by_key, lambda raw: staging.stage(raw, self.rules)
        )

    @cached_property
    def txn_enriched(self) -> DataFrame:
        return staging.enrich(self.txn_deduplicated)

    @cached_property
    def txn_filtered(self) -> DataFrame:
        return staging.keep_logical(self.txn_enriched)

    @cached_property
    def customer_activity_months(self) -> DataFrame:
        return snapshot.activity_months(self.txn_filtered)

    @cached_property
    def dim_months(self) -> DataFrame:
        return calendar.month_dimension(self.spark, self.rules)

    @cached_property
    def composite_grain(self) -> DataFrame:
        return snapshot.grain_of_activity(self.customer_activity_months, self.rules)

    @cached_property
    def customer_rfm(self) -> DataFrame:
        return rfm.rfm_full_refresh(self.txn_filtered, self.rules)

    @cached_property
    def uniqueness_counts(self) -> DataFrame:
        return quality.uniqueness_counts(self.raw)

    @cached_property
    def dq_completeness(self) -> DataFrame:
        return quality.completeness(self.raw)

    @cached_property
    def dq_validity(self) -> DataFrame:
        return quality.validity(self.raw, self.rules)

    @cached_property
    def dq_uniqueness(self) -> DataFrame:
        return quality.rated_uniqueness(self.uniqueness_counts)

    @cached_property
    def dq_consistency(self) -> DataFrame:
        return quality.consistency(self.raw)

    @cached_property
    def dq_summary(self) -> DataFrame:
        return scorecard.scorecard(self.raw, self.rules, key_counts=self.uniqueness_counts)

    @cached_property
    def dq_row_level_flags(self) -> DataFrame:
        return rowflags.row_level_flags(self.spark, self.raw, self.rules, rows=self.by_key)

    @cached_property
    def dq_usable_summary(self) -> DataFrame:
        return usable.usable_summary(self.dq_row_level_flags)


# Snapshot facts are stored by month, so an incremental run rewrites few of them.
PARTITIONED_BY = {
    "composite_grain": ("snapshot_date",),
    "customer_rfm": ("snapshot_date",),
}


def build(
    spark: SparkSession, raw: DataFrame, out_dir: str, rules: CleanRules | None = None
) -> dict[str, DataFrame]:
    """Full refresh: store every table under ``out_dir`` and return them as read back.

    The staged table stays a view. Tables that several others read are written
    first and read from storage, so each is computed once.
    """
    rules = rules or CleanRules()
    lazy = Lakehouse(spark, raw, rules)
    stored: dict[str, DataFrame] = {"stg_cleaned": lazy.stg_cleaned}

    def store(name: str, df: DataFrame) -> DataFrame:
        stored[name] = write_table(df, f"{out_dir}/{name}", PARTITIONED_BY.get(name, ()))
        return stored[name]

    deduplicated = store("txn_deduplicated", lazy.txn_deduplicated)
    enriched = store("txn_enriched", staging.enrich(deduplicated))
    filtered = store("txn_filtered", staging.keep_logical(enriched))
    store("customer_activity_months", snapshot.activity_months(filtered))
    store("dim_months", lazy.dim_months)
    grain = store("composite_grain", snapshot.composite_grain(filtered, rules))
    store("customer_rfm", rfm.rfm(grain, filtered))
    for name in ("dq_completeness", "dq_validity", "dq_uniqueness", "dq_consistency"):
        store(name, lazy[name])
    store("dq_summary", lazy.dq_summary)
    flags = store("dq_row_level_flags", lazy.dq_row_level_flags)
    store("dq_usable_summary", usable.usable_summary(flags))
    return {name: stored[name] for name in Lakehouse.NAMES}
