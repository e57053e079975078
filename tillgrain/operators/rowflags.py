"""Row-level quality flags and the global row number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillgrain.functions import flags
from tillgrain.operators.dedup import RAW_TIE_BREAK, ByKey, mark_by_key, mark_repeated
from tillgrain.rules import CleanRules
from tillgrain.sources.tables import materialise

OUTPUT_COLUMNS = (
    "invoice_no",
    "stock_code",
    "description",
    "quantity",
    "invoice_date",
    "unit_price",
    "country",
)


def row_flags(rules: CleanRules) -> dict[str, Column]:
    """The 16 flags that depend on nothing but the row itself."""
    complete = {c: f for c, f in flags.completeness().items() if c != "customer_id"}
    return {
        **{f"incomplete_{c}": f for c, f in complete.items()},
        **{f"invalid_{c}": f for c, f in flags.validity(rules).items()},
        **{f"inconsistent_{r}": f for r, f in flags.consistency().items()},
    }


def flag_rows(
    spark: SparkSession, raw: DataFrame, rules: CleanRules, rows: ByKey | None = None
) -> DataFrame:
    """Source columns plus all 17 flags; ``rows`` is the table by key, where that is known."""
    own = row_flags(rules)
    return (mark_repeated(raw) if rows is None else mark_by_key(rows)).select(
        *OUTPUT_COLUMNS, *[f.alias(n) for n, f in own.items()], "is_duplicate"
    )


def row_level_flags(
    spark: SparkSession,
    raw: DataFrame,
    rules: CleanRules,
    checked_at: Column | None = None,
    rows: ByKey | None = None,
) -> DataFrame:
    """Each raw row with its number of broken rules (0-17).

    All flags are computed on the row itself, so a row always gets its own
    flags. The rows are not sorted; sort when exporting.
    """
    return _error_counts(flag_rows(spark, raw, rules, rows), (), checked_at)


def numbered_row_flags(
    spark: SparkSession, raw: DataFrame, rules: CleanRules, checked_at: Column | None = None
) -> DataFrame:
    """``row_level_flags`` with each row's ``row_id``, by which an export is sorted.

    Equal rows are numbered with the unflagged one first.
    """
    marked = with_row_id(spark, mark_repeated(raw), (*ROW_ORDER, "is_duplicate"))
    own = [f.alias(n) for n, f in row_flags(rules).items()]
    flagged = marked.select("row_id", *OUTPUT_COLUMNS, *own, "is_duplicate")
    return _error_counts(flagged, ("row_id",), checked_at)


def _error_counts(
    flagged: DataFrame, also: tuple[str, ...], checked_at: Column | None
) -> DataFrame:
    names = [c for c in flagged.columns if c not in (*OUTPUT_COLUMNS, *also)]
    errors = sum((F.col(c) for c in names), F.lit(0))
    return flagged.select(
        *also,
        *OUTPUT_COLUMNS,
        flags.flag(errors > 0).alias("affected_row"),
        errors.alias("error_count"),
        (F.current_timestamp() if checked_at is None else checked_at).alias("dq_checked_at"),
    )


ROW_ORDER = ("invoice_date", "invoice_no", "stock_code", *RAW_TIE_BREAK)


def with_row_id(
    spark: SparkSession, raw: DataFrame, order_by: tuple[str, ...] = ROW_ORDER
) -> DataFrame:
    """Number all rows 1..n by invoice date and number, ties by the other columns.

    A range shuffle sorts the table across tasks and each task numbers its own
    rows while writing them; the only thing added up globally is one row count
    per written partition. Copies of a row are spread by the slice of the source
    they came from, so that they need not fit into one task.
    """
    order = [F.col(c).asc_nulls_last() for c in order_by]
    ranged = (
        raw.withColumn("_slice", F.spark_partition_id())
        .repartitionByRange(*order, F.col("_slice").asc())
        .sortWithinPartitions(*order)
        .drop("_slice")
        # Partition number in the upper bits, position within it in the lower 33.
        .withColumn("_position", F.monotonically_increasing_id())
    )
    stored = materialise(spark, ranged, "row_id")
    part = F.shiftright(F.col("_position"), 33)
    # One row per written partition, at most spark.sql.shuffle.partitions of them.
    sizes = stored.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(
        "_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before")
    )
    within = F.col("_position").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        stored.withColumn("_part", part)
        .join(F.broadcast(before), "_part")
        .withColumn("row_id", F.col("_before") + within + 1)
        .drop("_part", "_position", "_before")
    )
