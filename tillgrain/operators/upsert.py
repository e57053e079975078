"""Keyed upsert for tables without MERGE."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upsert(
    target: DataFrame,
    delta: DataFrame,
    keys: Sequence[str],
    settled: Column | None = None,
) -> DataFrame:
    """Target with the delta's rows replacing those of the same key.

    Rows that vanished from a recompute stay. ``settled`` tells which target
    rows cannot be in the delta (older than its first month, for instance):
    they skip the join, and on a table partitioned by that column the scan of
    the join side is pruned to the months being replaced.
    """
    delta = delta.select(*target.columns)
    if settled is None:
        return target.join(delta, list(keys), "left_anti").unionByName(delta)
    settled = F.coalesce(settled, F.lit(False))
    open_rows = target.where(~settled).join(delta, list(keys), "left_anti")
    return target.where(settled).unionByName(open_rows).unionByName(delta)
