"""Quality metrics of the raw table, one row per dimension.

Counts are one global aggregate; rates are derived from the counts, so several
dimensions can share one scan (see ``operators.scorecard``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillgrain.functions import flags
from tillgrain.functions.rates import RATE, complement_share, share
from tillgrain.operators.dedup import ByKey, key_counts
from tillgrain.rules import DQ_MODEL, ROW_KEY, CleanRules

def _n_total() -> Column:
    return F.col("n_total")



def _meta(dimension: str, run_at: Column | None) -> list[Column]:
    return [
        F.lit(DQ_MODEL[dimension]).alias("dq_model"),
        (F.current_timestamp() if run_at is None else run_at).alias("run_at"),
    ]


def _sum(flag: str, name: str) -> Column:
    # Zero, not unknown, on an empty table.
    return F.expr(f"coalesce(sum({flag}), 0) AS {name}")


def row_count() -> Column:
    return F.count(F.lit(1)).alias("n_total")


# -- flags: evaluated once per row, counted by the aggregates below -----------


def _completeness_columns() -> dict[str, Column]:
    return {f"{c}_incomplete": f for c, f in flags.completeness().items()}


def _validity_columns(rules: CleanRules) -> dict[str, Column]:
    return {f"{c}_invalid": f for c, f in flags.validity(rules).items()}


def _consistency_columns() -> dict[str, Column]:
    return {
        **{f"{rule}_broken": f for rule, f in flags.consistency().items()},
        "is_sale": flags.flag(F.col("quantity") > 0),
        "is_return": flags.flag(F.col("quantity") < 0),
    }


def _with_row_completeness(flagged: DataFrame) -> DataFrame:
    every = [F.col(f"{c}_incomplete") for c in flags.COMPLETENESS_COLUMNS]
    return flagged.withColumn("is_fully_complete", flags.all_zero(every))


def _with_row_validity(flagged: DataFrame) -> DataFrame:
    counted = [F.col(f"{c}_invalid") for c in flags.VALIDITY_COLUMNS]
    # An unlisted country does not make a row invalid.
    decisive = [F.col(f"{c}_invalid") for c in flags.VALIDITY_COLUMNS if c != "country"]
    return flagged.withColumns(
        {
            "invalid_flag_count": sum(counted, F.lit(0)),
            "is_fully_valid": flags.all_zero(decisive),
        }
    )


def _select(raw: DataFrame, kept: tuple[str, ...], columns: dict[str, Column]) -> DataFrame:
    return raw.select(*kept, *[c.alias(name) for name, c in columns.items()])


def scanned_counts(raw: DataFrame, rules: CleanRules) -> DataFrame:
    """One row: what completeness, validity and consistency count, from one scan."""
    return scanned_flags(raw, rules).agg(
        row_count(), *completeness_counts(), *validity_counts(), *consistency_counts()
    )


def scanned_flags(raw: DataFrame, rules: CleanRules) -> DataFrame:
    """All flags that need no shuffle, from one scan."""
    columns = {
        **_completeness_columns(),
        **_validity_columns(rules),
        **_consistency_columns(),
    }
    return _with_row_validity(_with_row_completeness(_select(raw, (), columns)))


# -- completeness ------------------------------------------------------------


def completeness_flags(raw: DataFrame) -> DataFrame:
    """Per row: which required values are missing, and whether none is."""
    return _with_row_completeness(_select(raw, ROW_KEY, _completeness_columns()))


def completeness_counts() -> list[Column]:
    return [
        _sum(f"{c}_incomplete", f"{c}_incomplete_count") for c in flags.COMPLETENESS_COLUMNS
    ] + [_sum("is_fully_complete", "fully_complete_row_count")]


def completeness_rates() -> dict[str, Column]:
    out = {}
    for c in flags.COMPLETENESS_COLUMNS:
        if c == "customer_id":  # optional by definition, never incomplete
            out[f"{c}_completeness_rate"] = F.lit(1).cast(RATE)
        else:
            out[f"{c}_completeness_rate"] = complement_share(
                F.col(f"{c}_incomplete_count"), _n_total()
            )
    out["fully_complete_row_rate"] = share(F.col("fully_complete_row_count"), _n_total())
    out["incomplete_row_count"] = _n_total() - F.col("fully_complete_row_count")
    return out


def completeness(raw: DataFrame, run_at: Column | None = None) -> DataFrame:
    """No row for an empty table."""
    counts = completeness_flags(raw).agg(row_count(), *completeness_counts())
    return rated_completeness(counts, run_at)


def rated_completeness(counts: DataFrame, run_at: Column | None = None) -> DataFrame:
    derived = completeness_rates()
    names = [f"{c}_completeness_rate" for c in flags.COMPLETENESS_COLUMNS]
    return counts.where(_n_total() > 0).withColumns(derived).select(
        "n_total",
        *names,
        "fully_complete_row_count",
        "fully_complete_row_rate",
        "incomplete_row_count",
        *[f"{c}_incomplete_count" for c in flags.COMPLETENESS_COLUMNS],
        *_meta("completeness", run_at),
    )


# -- validity ----------------------------------------------------------------

def validity_flags(raw: DataFrame, rules: CleanRules) -> DataFrame:
    """Per row: which values break a format, range or domain rule."""
    columns = _validity_columns(rules)
    return _with_row_validity(_select(raw, flags.VALIDITY_COLUMNS, columns))


def validity_counts() -> list[Column]:
    return [_sum(f"{c}_invalid", f"{c}_invalid_count") for c in flags.VALIDITY_COLUMNS] + [
        _sum("is_fully_valid", "fully_valid_row_count")
    ]


def validity_rates() -> dict[str, Column]:
    out = {
        f"{c}_validity_rate": complement_share(F.col(f"{c}_invalid_count"), _n_total())
        for c in flags.VALIDITY_COLUMNS
    }
    out["fully_valid_row_rate"] = share(F.col("fully_valid_row_count"), _n_total())
    out["invalid_row_count"] = _n_total() - F.col("fully_valid_row_count")
    return out


def validity(raw: DataFrame, rules: CleanRules, run_at: Column | None = None) -> DataFrame:
    """No row for an empty table."""
    counts = validity_flags(raw, rules).agg(row_count(), *validity_counts())
    return rated_validity(counts, run_at)


def rated_validity(counts: DataFrame, run_at: Column | None = None) -> DataFrame:
    return counts.where(_n_total() > 0).withColumns(validity_rates()).select(
        "n_total",
        *[f"{c}_invalid_count" for c in flags.VALIDITY_COLUMNS],
        *[f"{c}_validity_rate" for c in flags.VALIDITY_COLUMNS],
        "fully_valid_row_count",
        "fully_valid_row_rate",
        "invalid_row_count",
        *_meta("validity", run_at),
    )


# -- uniqueness --------------------------------------------------------------


def duplicate_groups(raw: DataFrame) -> DataFrame:
    """Keys, both parts known, that occur more than once."""
    return groups_of(key_counts(known_keys(raw)))


def known_keys(rows: DataFrame) -> DataFrame:
    return rows.where("invoice_no IS NOT NULL AND stock_code IS NOT NULL")


def groups_of(counts: DataFrame) -> DataFrame:
    """The repeated ones of counted keys."""
    return known_keys(counts).where(F.col("occurrence_count") > 1)


def uniqueness_counts(raw: DataFrame) -> DataFrame:
    """One shuffle: the row total is the sum of the key counts."""
    return uniqueness_of(key_counts(known_keys(raw)))


def uniqueness_by_key(rows: ByKey) -> DataFrame:
    """The same from the table by key: keys that occur once are not dealt."""
    repeated = key_counts(known_keys(rows.rest))
    if rows.once is None:
        return uniqueness_of(repeated)
    single = known_keys(rows.once).agg(F.count(F.lit(1)).alias("n_single"))
    counted = uniqueness_of(repeated)
    return counted.crossJoin(single).select(
        (_n_total() + F.col("n_single")).alias("n_total"),
        "composite_duplicate_group_count",
        "composite_duplicate_row_count",
    )


def uniqueness_of(counts: DataFrame) -> DataFrame:
    seen = F.col("occurrence_count")
    return known_keys(counts).agg(
        F.coalesce(F.sum(seen), F.lit(0)).alias("n_total"),
        F.count(F.when(seen > 1, 1)).alias("composite_duplicate_group_count"),
        F.coalesce(F.sum(F.when(seen > 1, seen - 1)), F.lit(0)).alias(
            "composite_duplicate_row_count"
        ),
    )


def uniqueness(raw: DataFrame, run_at: Column | None = None) -> DataFrame:
    return rated_uniqueness(uniqueness_counts(raw), run_at)


def rated_uniqueness(counts: DataFrame, run_at: Column | None = None) -> DataFrame:
    return counts.select(
        "*",
        complement_share(F.col("composite_duplicate_row_count"), _n_total()).alias(
            "composite_uniqueness_rate"
        ),
        *_meta("uniqueness", run_at),
    )


# -- consistency -------------------------------------------------------------


def consistency_counts() -> list[Column]:
    return [
        _sum(flag, count)
        for flag, count in (
            ("sales_price_broken", "sale_with_zero_price_count"),
            ("is_sale", "total_sale_rows"),
            ("return_price_broken", "return_with_nonpositive_price_count"),
            ("is_return", "total_return_rows"),
        )
    ]


def consistency_rates() -> dict[str, Column]:
    return {
        "sales_price_consistency_rate": complement_share(
            F.col("sale_with_zero_price_count"), F.col("total_sale_rows")
        ),
        "return_price_consistency_rate": complement_share(
            F.col("return_with_nonpositive_price_count"), F.col("total_return_rows")
        ),
    }


def consistency(raw: DataFrame, run_at: Column | None = None) -> DataFrame:
    flagged = _select(raw, (), _consistency_columns())
    return rated_consistency(flagged.agg(row_count(), *consistency_counts()), run_at)


def rated_consistency(counts: DataFrame, run_at: Column | None = None) -> DataFrame:
    return counts.withColumns(consistency_rates()).select(
        "n_total",
        "sale_with_zero_price_count",
        "total_sale_rows",
        "sales_price_consistency_rate",
        "return_with_nonpositive_price_count",
        "total_return_rows",
        "return_price_consistency_rate",
        *_meta("consistency", run_at),
    )
