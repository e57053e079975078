"""A folder of tables that change together: versions, each switched to by one file.

Data files are written under ``data/<table>/commit=<id>`` first and are never changed. A
version is one small file of ``manifest/version=<n>`` that names, for every table, the
folders it consists of: one per partition, from whichever commit wrote it last. The file becomes
visible by the rename that ends its write, so readers see all tables of the old version or
all of the new one, never a mixture. A write that breaks off before leaves folders that no
version names; the next commit has an id of its own and does not meet them.

One writer at a time: a second one that started from the same version fails to publish.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
_MANIFEST = "table string, schema string, partition_by string, folder string, commit string"


@dataclass(frozen=True)
class Buckets:
    """Rows dealt by a hash of ``columns`` into ``number`` files per partition."""

    number: int
    columns: tuple[str, ...]


@dataclass(frozen=True)
class TableState:
    """A table's columns, the partition column if any, and its (folder, commit) pairs."""

    schema: str
    partition_by: str | None
    folders: Mapping[str, str]


@dataclass(frozen=True)
class Snapshot:
    """All tables of one version, published or not."""

    spark: SparkSession
    root: str
    version: int
    tables: Mapping[str, TableState]

    def partitions(self, name: str) -> list[str | None]:
        """Values of the partition column, as text, unknown ones as None."""
        values = [f.split("=", 1)[1] for f in self.tables[name].folders if f]
        return sorted((None if v == NULL_FOLDER else v for v in values), key=lambda v: v or "")

    def read(self, name: str, only: Iterable[str | None] | None = None) -> DataFrame:
        """The table, or the named partitions alone: other folders are not even listed."""
        state = self.tables[name]
        base = f"{self.root}/data/{name}"
        folders = state.folders
        if only is not None:
            wanted = {f"{state.partition_by}={NULL_FOLDER if v is None else v}" for v in only}
            folders = {f: c for f, c in folders.items() if f in wanted}
        schema = T.StructType.fromJson(json.loads(state.schema))
        if not folders:
            return self.spark.createDataFrame([], schema)
        paths = [f"{base}/commit={c}/{f}".rstrip("/") for f, c in sorted(folders.items())]
        rows = self.spark.read.schema(schema).option("basePath", base).parquet(*paths)
        return rows.select(*schema.names)

    def bucketed(self, name: str, buckets: Buckets) -> DataFrame:
        """A table written in buckets: grouping and joining by their columns needs no shuffle.

        Bucketing is known to Spark's catalog alone, so the folders of this version are
        declared there as the partitions of an external table, under a name of its own.
        """
        state = self.tables[name]
        schema = T.StructType.fromJson(json.loads(state.schema))
        declared = f"{name}_v{self.version}_{uuid.uuid4().hex}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        keys = ", ".join(f"`{c}`" for c in buckets.columns)
        self.spark.sql(
            f"CREATE TABLE {declared} ({columns}) USING parquet"
            f" PARTITIONED BY (`{state.partition_by}`) CLUSTERED BY ({keys}) SORTED BY ({keys})"
            f" INTO {buckets.number} BUCKETS LOCATION '{self.root}/data/{name}'"
        )
        for folder, commit in sorted(state.folders.items()):
            value = folder.split("=", 1)[1]
            self.spark.sql(
                f"ALTER TABLE {declared} ADD PARTITION (`{state.partition_by}` = '{value}')"
                f" LOCATION '{self.root}/data/{name}/commit={commit}/{folder}'"
            )
        return self.spark.table(declared).select(*schema.names)


class VersionedStore:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def latest(self) -> Snapshot | None:
        """The newest published version; None in a new folder."""
        try:
            manifests = self.spark.read.schema(f"{_MANIFEST}, version int").parquet(
                f"{self.root}/manifest"
            )
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        # A partition column: its greatest value comes from the folder names.
        newest = manifests.agg(F.max("version")).first()[0]
        if newest is None:
            return None
        entries: dict[str, list] = {}
        for r in manifests.where(F.col("version") == newest).collect():
            entries.setdefault(r["table"], []).append(r)
        tables = {
            name: TableState(
                rows[0]["schema"],
                rows[0]["partition_by"],
                {r["folder"]: r["commit"] for r in rows if r["folder"] is not None},
            )
            for name, rows in entries.items()
        }
        return Snapshot(self.spark, self.root, newest, tables)

    def begin(self, base: Snapshot | None) -> Commit:
        return Commit(self, base)


class Commit:
    """Tables being written on top of a version; nothing shows before ``publish``."""

    def __init__(self, store: VersionedStore, base: Snapshot | None) -> None:
        self.id = f"c{uuid.uuid4().hex}"
        self._store = store
        self.version = 1 if base is None else base.version + 1
        self._tables: dict[str, TableState] = {} if base is None else dict(base.tables)

    def write(
        self,
        name: str,
        df: DataFrame,
        partition_by: str | None = None,
        replaces: Iterable[str | None] | None = None,
        buckets: Buckets | None = None,
        per_bucket: Callable[[DataFrame], DataFrame] | None = None,
        clustered: bool = False,
    ) -> DataFrame:
        """Write a table, or the partitions ``replaces`` of one, and return what it then is.

        Partitions to be replaced that get no row are gone afterwards. Rows of a table in
        ``buckets`` should be few per bucket key: they are dealt by it. ``per_bucket`` is applied
        to the dealt rows; what it groups by the buckets' columns needs no shuffle of its own.
        ``clustered`` rows lie by partition already, as read from a table stored so: they are
        written as they lie, too.
        """
        replaces = None if replaces is None else list(replaces)
        path = f"{self._store.root}/data/{name}/commit={self.id}"
        writer = df.write
        if partition_by and (clustered or (replaces is not None and len(replaces) == 1)):
            # All rows go into one folder, or a task's into few: they are written as they lie.
            writer = df.write.partitionBy(partition_by)
        elif partition_by:
            # Few files per partition, large partitions split over several tasks.
            writer = df.hint("rebalance", F.col(partition_by)).write.partitionBy(partition_by)
        if buckets is None:
            writer.parquet(path)
        else:
            # Buckets are written through the catalog; the name is not needed afterwards.
            passing = f"{name}_{self.id}"
            df = df.repartition(buckets.number, *buckets.columns)
            df = df if per_bucket is None else per_bucket(df)
            dealt = df.write.format("parquet").bucketBy(buckets.number, *buckets.columns)
            dealt = dealt.sortBy(*buckets.columns)
            dealt.partitionBy(partition_by).option("path", path).saveAsTable(passing)
            self._store.spark.sql(f"DROP TABLE {passing}")
        if partition_by:
            files = self._store.spark.read.schema(df.schema).parquet(path).inputFiles()
            pattern = re.compile(rf"/({re.escape(partition_by)}=[^/]*)/")
            written = {m.group(1): self.id for f in files if (m := pattern.search(f))}
        else:
            written = {"": self.id}
        old = self._tables.get(name)
        if replaces is not None and old is not None:
            gone = {f"{partition_by}={NULL_FOLDER if v is None else v}" for v in replaces}
            stray = set(written) - gone
            if stray:
                raise ValueError(f"rows outside the replaced partitions of {name}: {stray}")
            written = {f: c for f, c in old.folders.items() if f not in gone} | written
        self._tables[name] = TableState(df.schema.json(), partition_by, written)
        return self.snapshot().read(name)

    def snapshot(self) -> Snapshot:
        """The tables as they would be published."""
        return Snapshot(self._store.spark, self._store.root, self.version, dict(self._tables))

    def publish(self) -> Snapshot:
        rows = [
            (name, t.schema, t.partition_by, folder, commit)
            for name, t in sorted(self._tables.items())
            for folder, commit in (sorted(t.folders.items()) or [(None, None)])
        ]
        entries = self._store.spark.createDataFrame(rows, _MANIFEST).coalesce(1)
        path = f"{self._store.root}/manifest/version={self.version}"
        # One file, and an error if another writer was first.
        entries.write.mode("errorifexists").parquet(path)
        return self.snapshot()
