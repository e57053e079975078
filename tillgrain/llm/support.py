"""Helpers the operators share: inputs, scratch tables, Arrow batches, runs of equal keys."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
from collections.abc import Callable, Iterable, Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tillgrain.sources.tables import materialise

__all__ = ["grouped", "importable", "map_batches", "materialise", "table", "texts_of"]

_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def importable(spark: SparkSession) -> None:
    """Let Python workers of this session import the package from where the driver has it,
    and send them texts in smaller batches than the default of 10,000 rows.

    On a cluster the package is installed or shipped with ``--py-files``; the
    extra path is then simply one that does not exist.
    """
    if spark.conf.get(_BATCH_ROWS) == "10000":
        spark.conf.set(_BATCH_ROWS, "1000")
    environment = spark.sparkContext.environment
    top = str(Path(__file__).resolve().parents[2])
    known = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if top not in known:
        environment["PYTHONPATH"] = os.pathsep.join([*known, top])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def give_back() -> None:
    """Return freed memory to the system: Python workers are kept for later tasks, several
    to an executor, and would each hold what their largest task took."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def map_batches(
    df: DataFrame, step: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], schema: str
) -> DataFrame:
    """``mapInArrow`` for a step that yields dicts of columns, in the order of ``schema``."""
    importable(df.sparkSession)
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for columns in step(batches):
                yield pa.RecordBatch.from_arrays([pa.array(columns[n]) for n in names], names)
        finally:
            give_back()

    return df.mapInArrow(run, schema)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> Iterator[bytes]:
    """The texts as UTF-8, null as empty."""
    for value in batch.column(batch.schema.get_field_index(name)).cast(pa.large_binary()):
        yield value.as_py() or b""


def grouped(
    batches: Iterable[pa.RecordBatch], keys: Sequence[str]
) -> Iterator[list[pa.RecordBatch]]:
    """Runs of equal integer keys in sorted rows, also where a run spans batches."""
    held: list[pa.RecordBatch] = []
    last: tuple | None = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        columns = [
            batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False)
            for k in keys
        ]
        change = np.zeros(batch.num_rows - 1, dtype=bool)
        for column in columns:
            change |= column[1:] != column[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:], strict=False):
            key = tuple(column[start] for column in columns)
            if last is not None and key != last:
                yield held
                held = []
            held.append(batch.slice(start, end - start))
            last = key
    if held:
        yield held
