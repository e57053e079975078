"""Keys of all loads as stored state: duplicate flags and uniqueness that move with each load.

Three tables of a versioned store change together, each with one partition per load: the flags
of the load's rows among themselves, its keys (rows and earliest row of each) and the keys
overruled by it. A load is flagged by itself. Where its keys are known from earlier loads, one
of two loads loses its claim to the earliest row: the load itself, or the one that held it so
far. The pair (load, key) is written down as overruled, and the rows of earlier loads are
neither read nor written.

Keys are stored in buckets of their hash. Known and new keys meet bucket by bucket, so a load
shuffles its own rows and keys alone; ``compact`` puts the keys of all loads into one partition.

Equal rows of one key in two loads: the earlier load's counts as the earliest. Keys with an
unknown part are grouped together, as in ``mark_duplicates``. An empty load makes a version.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillgrain.operators import quality
from tillgrain.operators.dedup import RAW_TIE_BREAK, mark_repeated
from tillgrain.rules import RAW_COLUMNS, ROW_KEY
from tillgrain.sources.versions import Buckets, Commit, Snapshot, VersionedStore

# Buckets of a new store, kept for its life. Choose so many that those of one bucket, of all
# loads, fit a task; a task takes one bucket.
BUCKETS = 1024
_HASHED = tuple(f"{k}_text" for k in ROW_KEY)


def _texts() -> list[Column]:
    """Key parts that are never NULL, so that plain equality, and with it buckets, serve."""
    return [
        F.coalesce(F.concat(F.lit("="), F.col(k)), F.lit("")).alias(t)
        for k, t in zip(ROW_KEY, _HASHED, strict=True)
    ]


def _parts() -> list[Column]:
    return [
        F.when(F.col(t) != "", F.expr(f"substring({t}, 2)")).alias(k)
        for k, t in zip(ROW_KEY, _HASHED, strict=True)
    ]


def _place() -> Column:
    """A row's place among those of its key: the order of ``mark_duplicates``, unknown last."""
    names = ("invoice_date", *RAW_TIE_BREAK)
    return F.struct(
        *[c for n in names for c in (F.col(n).isNull().alias(f"no_{n}"), F.col(n))]
    )


class KeyStore:
    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS) -> None:
        """``buckets`` counts for a new store; an older one keeps its own."""
        self.spark = spark
        self.store = VersionedStore(spark, root)
        self._new_buckets = buckets

    def add(self, raw: DataFrame) -> Snapshot:
        """Publish the version after one more load."""
        return self.staged(raw).publish()

    def staged(self, raw: DataFrame) -> Commit:
        base = self.store.latest()
        commit = self.store.begin(base)
        number, load = commit.version, F.lit(commit.version)
        if base is None:
            layout = self.spark.createDataFrame([(self._new_buckets,)], "buckets int")
            commit.write("layout", layout.coalesce(1))
        buckets = self._buckets(commit.snapshot())
        own = [str(number)]
        marked = mark_repeated(raw.select(*RAW_COLUMNS)).withColumn("load", load)
        commit.write("flags", marked, "load", own)
        rows = commit.snapshot().read("flags", own)
        earliest = F.struct(_place().alias("place"), "load")
        # Every key of the load has one unflagged row, its earliest; the others are only counted.
        one = rows.where(F.col("is_duplicate") == 0)
        one = one.select(*_texts(), F.lit(1).cast("bigint").alias("n"), earliest.alias("first"))
        more = rows.where(F.col("is_duplicate") != 0).groupBy(*_texts())
        keys = one.unionByName(more.agg(F.count(F.lit(1)).alias("n")), allowMissingColumns=True)
        united = lambda dealt: self._united(dealt).withColumn("load", load)
        commit.write("keys", keys, "load", own, buckets, united)
        commit.write("overruled", self.overruled_by(commit).withColumn("load", load), "load", own)
        return commit

    def overruled_by(self, commit: Commit) -> DataFrame:
        """(key, loser): for each key of the load known before, the load whose row gives way."""
        at = commit.snapshot()
        keys = at.bucketed("keys", self._buckets(at))
        known = self._united(keys.where(F.col("load") < commit.version))
        known = known.select(*_HASHED, F.col("first").alias("before"))
        # A struct's order goes on to the load: of equal rows the earlier load's is first.
        both = keys.where(F.col("load") == commit.version).join(known, [*_HASHED])
        loser = F.greatest("first", "before")["load"]
        return both.select(*_HASHED, loser.alias("loser"))

    def compact(self) -> Snapshot:
        """Publish a version with the keys of all loads in one partition."""
        base = self.latest()
        commit = self.store.begin(base)
        buckets = self._buckets(base)
        united = self._united(base.bucketed("keys", buckets)).withColumn("load", F.lit(commit.version))
        replaced = [*base.partitions("keys"), str(commit.version)]
        commit.write("keys", united, "load", replaced, buckets)
        return commit.publish()

    # -- what is read ----------------------------------------------------------

    def latest(self) -> Snapshot:
        found = self.store.latest()
        if found is None:
            raise ValueError("the store holds no load yet: begin with add()")
        return found

    def flags(self, at: Snapshot | None = None) -> DataFrame:
        """Rows of all loads with ``is_duplicate``, as ``mark_duplicates`` of them all gives it."""
        at = at or self.latest()
        rows = at.read("flags")
        gone = at.read("overruled").select(
            *[F.col(t).alias(f"_{t}") for t in _HASHED], F.col("loser")
        )
        # Only the earliest row of a key in its load can give way: one row per load and key.
        held = rows.where(F.col("is_duplicate") == 0)
        texts = zip(_texts(), _HASHED, strict=True)
        same = [c == F.col(f"_{t}") for c, t in texts]
        settled = held.join(gone, [*same, F.col("load") == F.col("loser")], "left").withColumn(
            "is_duplicate", F.when(F.col("loser").isNotNull(), 1).otherwise(0)
        )
        repeated = rows.where(F.col("is_duplicate") != 0)
        return settled.select(*rows.columns).unionByName(repeated).drop("load")

    def counts(self, at: Snapshot | None = None) -> DataFrame:
        """Rows per key over all loads; no shuffle, and no row of a load is read."""
        at = at or self.latest()
        keys = at.bucketed("keys", self._buckets(at))
        total = keys.groupBy(*_HASHED).agg(F.sum("n").alias("occurrence_count"))
        return total.select(*_parts(), "occurrence_count")

    def duplicate_groups(self, at: Snapshot | None = None) -> DataFrame:
        return quality.groups_of(self.counts(at))

    def uniqueness(self, run_at: Column | None = None, at: Snapshot | None = None) -> DataFrame:
        return quality.rated_uniqueness(quality.uniqueness_of(self.counts(at)), run_at)

    def _united(self, keys: DataFrame) -> DataFrame:
        return keys.groupBy(*_HASHED).agg(F.sum("n").alias("n"), F.min("first").alias("first"))

    def _buckets(self, at: Snapshot) -> Buckets:
        return Buckets(at.read("layout").first()["buckets"], _HASHED)
