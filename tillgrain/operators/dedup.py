"""Duplicate handling on the composite key (invoice_no, stock_code)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillgrain.rules import ROW_KEY
from tillgrain.sources.tables import materialise

STAGED_TIE_BREAK = ("quantity", "unit_price", "customer_id", "country")
# Rows of one key that a task ranks by itself; a key with more is split.
HOT_ROWS = 1_000_000
# Repeated keys whose hashes are broadcast, eight bytes each, to tell the rows that need no rank.
REPEATED_KEYS = 1_000_000

RAW_TIE_BREAK = ("quantity", "unit_price", "customer_id", "country", "description")


def _ascending(names: tuple[str, ...]) -> list[Column]:
    return [F.col(n).asc_nulls_last() for n in names]


def keep_latest(staged: DataFrame) -> DataFrame:
    """One row per key: the latest, an unknown date counting as latest.

    The ``rn = 1`` filter lets Spark prune every key to one row per map task
    before the shuffle, so a hot key sends at most one row per task.
    """
    latest = Window.partitionBy(*ROW_KEY).orderBy(
        F.col("invoice_date").desc_nulls_first(), *_ascending(STAGED_TIE_BREAK)
    )
    return staged.withColumn("rn", F.row_number().over(latest)).where(F.col("rn") == 1)


def key_counts(raw: DataFrame) -> DataFrame:
    """Rows per key, unknown key parts grouping together."""
    return raw.groupBy(*ROW_KEY).agg(F.count(F.lit(1)).alias("occurrence_count"))


def mark_duplicates(raw: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add ``is_duplicate``: 0 on the earliest row of each key, 1 on the others.

    Keys of more than ``hot_rows`` rows are split: their rows are ranked in two steps,
    see ``_rank_by_slice``. Every other key fits into one task and is ranked by one
    ordinary window. Hot keys are told by a 64-bit hash of the key, counted with partial
    aggregation; their hashes are broadcast, eight bytes each and fewer of them than
    rows / ``hot_rows``, however long the keys are. A cold key that shares the hash of a
    hot one is ranked with it in two steps, by its own key all the same.
    """
    hashed = raw.withColumn("_hash", F.xxhash64(*ROW_KEY))
    hot = F.broadcast(
        hashed.groupBy("_hash")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > hot_rows)
        .select("_hash")
    )
    order = [F.col("invoice_date").asc_nulls_last(), *_ascending(RAW_TIE_BREAK)]
    rank = F.row_number().over(Window.partitionBy(*ROW_KEY).orderBy(*order))
    rest = (
        hashed.join(hot, "_hash", "left_anti")
        .withColumn("is_duplicate", F.when(rank > 1, 1).otherwise(0))
        .drop("_hash")
    )
    sliced = hashed.withColumn("_slice", F.spark_partition_id())
    split = sliced.join(hot, "_hash", "left_semi").drop("_hash")
    return rest.select(*raw.columns, "is_duplicate").unionByName(_rank_by_slice(split, order))


@dataclass(frozen=True)
class ByKey:
    """The rows of a raw table in two parts that share no key, trimmed or not."""

    once: DataFrame | None
    rest: DataFrame


def by_key(raw: DataFrame, repeated_keys: int = REPEATED_KEYS) -> ByKey:
    """Rows whose trimmed key occurs once, and the others.

    Hashes of the trimmed keys are counted while planning; those that occur again are stored and
    broadcast, and their rows are stored, so that only these are dealt by key. A table with more
    than ``repeated_keys`` of them is the rest as a whole.
    """
    spark = raw.sparkSession
    hashed = raw.withColumn("_hash", F.xxhash64(*[F.trim(c) for c in ROW_KEY]))
    counted = hashed.groupBy("_hash").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    repeated = materialise(spark, counted.select("_hash"), "repeated_keys")
    if repeated.count() > repeated_keys:
        return ByKey(None, raw)
    known = F.broadcast(repeated)
    once = hashed.join(known, "_hash", "left_anti").select(*raw.columns)
    rest = hashed.join(known, "_hash", "left_semi").select(*raw.columns)
    return ByKey(once, materialise(spark, rest, "repeated_rows"))


def keep_latest_by_key(rows: ByKey, staged: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``keep_latest`` of the staged table that deals only the rows of repeated keys."""
    latest = keep_latest(staged(rows.rest))
    if rows.once is None:
        return latest
    return staged(rows.once).withColumn("rn", F.lit(1)).unionByName(latest)


def mark_by_key(rows: ByKey) -> DataFrame:
    """``mark_duplicates`` that deals only the rows of repeated keys; the others are 0."""
    marked = mark_duplicates(rows.rest)
    if rows.once is None:
        return marked
    return rows.once.withColumn("is_duplicate", F.lit(0)).unionByName(marked)


def mark_repeated(raw: DataFrame, repeated_keys: int = REPEATED_KEYS) -> DataFrame:
    """``mark_by_key`` of a table whose keys were not counted before."""
    return mark_by_key(by_key(raw, repeated_keys))


def _rank_by_slice(rows: DataFrame, order: list[Column]) -> DataFrame:
    """Mark all but the first row per key when a key may hold any number of rows.

    Rows are ranked within the slice of the table that one task read, then the
    winners of the slices, at most one per key and task, among each other. The
    slice is the task's number, so a task that is run again gives the same one.
    """
    within = Window.partitionBy(*ROW_KEY, "_slice").orderBy(*order)
    among = Window.partitionBy(*ROW_KEY, "_round").orderBy(*order)
    first = F.col("_first") & (F.col("_rank") == 1)
    return (
        # Explicit exchanges on all the columns: partitioning by the key alone
        # would satisfy the windows too, with a hot key in one task.
        rows.repartition(*ROW_KEY, "_slice")
        .withColumn("_first", F.row_number().over(within) == 1)
        .withColumn("_round", F.when(F.col("_first"), F.lit(-1)).otherwise(F.col("_slice")))
        .repartition(*ROW_KEY, "_round")
        .withColumn("_rank", F.row_number().over(among))
        .withColumn("is_duplicate", F.when(first, 0).otherwise(1))
        .drop("_slice", "_first", "_round", "_rank")
    )
