"""Stored tables: layer writer, shared scratch tables, partition-wise merge."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillgrain.operators.upsert import upsert


_LOCAL_FOLDERS: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables, as named by ``spark.checkpoint.dir``.

    Only a local-mode session, whose executors share one machine, may fall back
    to a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if context.master.startswith("local"):
        if context.applicationId not in _LOCAL_FOLDERS:
            _LOCAL_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="tillgrain-")
        return _LOCAL_FOLDERS[context.applicationId]
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder's path in the shared folder."""
    return f"{checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(
    spark: SparkSession, df: DataFrame, label: str, partition_by: str | None = None
) -> DataFrame:
    """Write once to the shared folder and read back: cuts the lineage and
    outlives the executors that computed it."""
    path = scratch_path(spark, label)
    if partition_by:
        spread = df.hint("rebalance", F.col(partition_by))
        spread.write.partitionBy(partition_by).parquet(path)
        return spark.read.schema(df.schema).parquet(path).select(*df.columns)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_STORED: dict[tuple[str, ...], DataFrame] = {}


def is_stored(spark: SparkSession, label: str, source: str) -> bool:
    """Whether ``stored_once`` has written this table in this application."""
    return (spark.sparkContext.applicationId, label, source) in _STORED


def stored_once(
    spark: SparkSession,
    label: str,
    source: str,
    build: Callable[[], DataFrame],
    partition_by: str | None = None,
) -> DataFrame:
    """A table derived from ``source``, written on first use in this application."""
    key = (spark.sparkContext.applicationId, label, source)
    if key not in _STORED:
        _STORED[key] = materialise(spark, build(), label, partition_by)
    return _STORED[key]


def write_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite"
) -> DataFrame:
    """Store one layer and return it as read back."""
    if partition_by:
        # Few files per partition, large partitions split over several tasks.
        spread = df.hint("rebalance", *[F.col(c) for c in partition_by])
        spread.write.mode(mode).partitionBy(*partition_by).parquet(path)
    else:
        df.write.mode(mode).parquet(path)
    return df.sparkSession.read.parquet(path)


def merge_into_partitions(
    spark: SparkSession,
    path: str,
    delta: DataFrame,
    keys: Sequence[str],
    partition_column: str,
) -> DataFrame:
    """Upsert that rewrites only the partitions the delta touches.

    ``partition_column`` must be one of the keys, so that a row and its
    replacement share a partition. The merged rows are staged first, in a folder
    ``merged-*`` of the shared folder: the old partitions are replaced only by data already
    written in full. A write that breaks off may leave some partitions new and some old;
    running the same merge again, which is idempotent, completes it.
    """
    if partition_column not in keys:
        raise ValueError("the partition column must be part of the key")
    staged_delta = materialise(spark, delta, "delta")
    # One value per partition directory: small. The bounds, as scalar subqueries, prune the
    # scan of the target to the span of the delta; the join leaves the months in between.
    touched = F.broadcast(staged_delta.select(partition_column).distinct())
    low = staged_delta.agg(F.min(partition_column)).scalar()
    high = staged_delta.agg(F.max(partition_column)).scalar()
    target = spark.read.parquet(path).where(F.col(partition_column).between(low, high))
    replaced = target.join(touched, partition_column, "left_semi").select(*target.columns)
    merged = materialise(spark, upsert(replaced, staged_delta, keys), "merged")
    (
        # Few files per partition, large partitions split over several tasks.
        merged.hint("rebalance", F.col(partition_column))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_column)
        .parquet(path)
    )
    return spark.read.parquet(path)
