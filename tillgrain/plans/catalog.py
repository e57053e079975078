"""Named queries over a star-schema folder, one per operator.

Every query starts from the raw lines of ``sources.star_adapter``. At this
boundary money and rates are doubles and run timestamps are left out, so that
results can be compared across engines.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillgrain.operators import (
    assertions,
    balances,
    calendar,
    checks,
    quality,
    rfm,
    rowflags,
    scorecard,
    snapshot,
)
from tillgrain.plans import incremental, suite
from tillgrain.plans.key_store import KeyStore
from tillgrain.plans.pipeline import Lakehouse
from tillgrain.plans.stored_state import StateStore
from tillgrain.sources import dates, ingest
from tillgrain.sources.star_adapter import STAR_RULES, stored_lines
from tillgrain.sources.tables import is_stored, materialise, scratch_path, stored_once
from tillgrain.sources.versions import Snapshot

Query = Callable[[SparkSession, str], DataFrame]

RUN_TIMESTAMPS = ("run_at", "dq_checked_at", "computed_at")

# Month from which the incremental queries treat transactions as new.
INCREMENT_FROM = "2000-07-01 00:00:00"


def reported(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in df.schema.fields
            if f.name not in RUN_TIMESTAMPS
        ]
    )


def lakehouse(spark: SparkSession, sf_dir: str) -> Lakehouse:
    return Lakehouse(spark, stored_lines(spark, sf_dir), STAR_RULES)


def _kept(name: str, plan: Callable[[Lakehouse], DataFrame] | None = None) -> cached_property:
    """A table of the lakehouse that is written on first use, unless it is read once."""
    plan = plan or getattr(Lakehouse, name).func

    def table(house: StoredTables) -> DataFrame:
        if name in house.read_once and not is_stored(house.spark, name, house.source):
            return plan(house)
        return stored_once(house.spark, name, house.source, lambda: plan(house))

    return cached_property(table)


# What the declared checks and the summary read of the row flags; the rest is the raw table again.
FLAG_COLUMNS = ("affected_row", "error_count", "dq_checked_at")


@dataclass(frozen=True)
class StoredTables(Lakehouse):
    """Tables of a source folder. Those that take a shuffle are stored on first use, and what
    builds on them reads them stored; the others are projections of these. A table in
    ``read_once`` is not stored, so that only the columns its one reader needs are computed.
    Of the row flags ``FLAG_COLUMNS`` are kept."""

    source: str = ""
    read_once: frozenset[str] = frozenset()

    @cached_property
    def scanned_counts(self) -> DataFrame:
        """Stored, unless one table is made of it, which needs few of the counts."""
        counts = quality.scanned_counts(self.raw, self.rules)
        if "scanned_counts" in self.read_once:
            return counts
        return materialise(self.spark, counts, "scanned_counts")

    txn_deduplicated = _kept("txn_deduplicated")
    customer_activity_months = _kept("customer_activity_months")
    composite_grain = _kept("composite_grain")
    customer_rfm = _kept("customer_rfm")
    dq_completeness = _kept(
        "dq_completeness", lambda house: quality.rated_completeness(house.scanned_counts)
    )
    dq_validity = _kept("dq_validity", lambda house: quality.rated_validity(house.scanned_counts))
    uniqueness_counts = _kept(
        "uniqueness_counts", lambda house: quality.uniqueness_by_key(house.by_key)
    )
    dq_uniqueness = _kept("dq_uniqueness")
    dq_consistency = _kept(
        "dq_consistency", lambda house: quality.rated_consistency(house.scanned_counts)
    )
    dq_summary = _kept(
        "dq_summary",
        lambda house: scorecard.scorecard(
            house.raw,
            house.rules,
            key_counts=house.uniqueness_counts,
            counts=house.scanned_counts,
        ),
    )
    dq_row_level_flags = _kept(
        "dq_row_level_flags",
        lambda house: Lakehouse.dq_row_level_flags.func(house).select(*FLAG_COLUMNS),
    )
    dq_usable_summary = _kept("dq_usable_summary")


def stored_tables(
    spark: SparkSession, sf_dir: str, read_once: frozenset[str] = frozenset()
) -> StoredTables:
    return StoredTables(spark, stored_lines(spark, sf_dir), STAR_RULES, sf_dir, read_once)


def _over(build: Callable[[Lakehouse], DataFrame]) -> Query:
    return lambda spark, sf_dir: reported(build(lakehouse(spark, sf_dir)))


def _table(name: str) -> Query:
    return _over(lambda house: house[name])


def order_dates_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates as a text column in several formats; some entries are not dates."""
    key = F.col("o_orderkey")
    good = F.date_format(F.col("o_orderdate"), "yyyy-MM-dd HH:mm:ss")
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey",
        F.when(key % 7 == 0, F.lit("not a date"))
        .when(key % 11 == 0, F.lit("2010-13-45 00:00:00"))
        .when(key % 13 == 0, F.lit(""))
        .when(key % 17 == 0, F.lit(None))
        .when(key % 19 == 0, F.date_format(F.col("o_orderdate"), "M/d/yyyy H:mm"))
        .when(key % 23 == 0, F.date_format(F.col("o_orderdate"), "yyyy"))
        .otherwise(good)
        .alias("date_text"),
    )


def _timestamp_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = order_dates_as_text(spark, sf_dir)
    return text.withColumn("invoice_date", dates.parse_timestamp(F.col("date_text")))


def order_dates_by_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates with slashes as four files write them: month first, day first, only days
    that could be months, and both ways."""
    date, file = F.col("o_orderdate"), F.col("o_custkey") % 4
    day_first = (file == 1) | ((file == 3) & (F.col("o_orderkey") % 2 == 0))
    text = (
        F.when((file == 2) & (F.dayofmonth(date) > 12), None)
        .when(day_first, F.date_format(date, "d/M/yyyy H:mm"))
        .otherwise(F.date_format(date, "M/d/yyyy H:mm"))
    )
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", F.concat(F.lit("f"), file.cast("string")).alias("file"), text.alias("date_text")
    )


def _date_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = order_dates_by_file(spark, sf_dir)
    # Stored, one row per file: its size is known when the join is planned, so that the rows
    # of a large file are not dealt into one task.
    orders = materialise(spark, dates.date_orders(rows, "date_text", "file"), "date_orders")
    return dates.parse_by_file(rows, "date_text", "file", orders).select(
        "o_orderkey", "file", "date_text", "date_order", F.col("parsed").alias("invoice_date")
    )


def _quoted_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as CSV, with line breaks inside quotes and bare inch marks, and read."""
    key = F.col("o_orderkey")
    order = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        key.cast("string").alias("invoice_no"),
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("stock_code"),
        F.when(key % 5 == 0, F.concat(F.lit("first\n\nsecond, of "), key.cast("string")))
        .when(key % 7 == 0, F.lit('6" RULER'))
        .otherwise(F.lit("PLAIN"))
        .alias("description"),
        (key % 100).cast("string").alias("quantity"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("invoice_date"),
        F.lit("0.5").alias("unit_price"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.lit("France").alias("country"),
    )
    path = scratch_path(spark, "csv")
    order.write.option("header", True).option("escapeQuotes", False).csv(path)
    return ingest.typed(ingest.read_csv(spark, path))


# -- incremental runs: the tables an earlier run stored, then the new transactions --


class _State:
    """Stored monthly totals by month, the facts an earlier run derived from the earlier of them,
    and the balances it left for the months before the next run's look-back."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        house = lakehouse(spark, sf_dir)

        def stored(
            label: str, build: Callable[[], DataFrame], partition_by: str | None = None
        ) -> DataFrame:
            return stored_once(spark, label, sf_dir, build, partition_by)

        self.rules = house.rules
        # The increment begins with a month, so the totals of the earlier lines are those of the
        # earlier months: the lines are deduplicated and added up once for both runs.
        self.totals = stored(
            "totals_by_month", lambda: balances.totals_of(house.txn_filtered), "txn_month"
        )
        first_new = F.to_date(F.lit(INCREMENT_FROM))
        earlier = self.totals.where(F.col("txn_month") < first_new)
        self.rfm = stored(
            "earlier_rfm", lambda: rfm.rfm_of_months(earlier, self.rules), "snapshot_date"
        )
        self.balances = stored(
            "earlier_balances",
            lambda: balances.before(snapshot.look_back_start(self.rfm), earlier),
        )

    def facts(self) -> DataFrame:
        """RFM and grain after the next run; it reads no total from before its look-back."""
        since = snapshot.look_back_start(self.rfm)
        opened = self.totals.where(F.col("txn_month") >= since)
        return incremental.facts_incremental(self.rfm, self.balances, opened, self.rules)


class _MovedState:
    """Facts of an earlier run whose keys were partly dated elsewhere since.

    Some transactions stood two months earlier then, so first, middle and last months have
    moved; customers who only bought in the later months are new, and a customer known
    under another id then is gone.
    """

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        house = stored_tables(spark, sf_dir)
        self._spark, self._sf_dir, self.rules = spark, sf_dir, house.rules
        self.filtered = house.txn_filtered
        moved = F.pmod(F.xxhash64("invoice_no", "stock_code"), F.lit(23)) == 0
        renamed = F.pmod(F.xxhash64("customer_id"), F.lit(31)) == 0
        before = F.col("invoice_date") < F.lit(INCREMENT_FROM)
        self.earlier = self.filtered.where(before).withColumns(
            {
                "invoice_date": F.when(
                    moved, F.col("invoice_date") - F.expr("INTERVAL 61 DAYS")
                ).otherwise(F.col("invoice_date")),
                "customer_id": F.when(renamed, F.concat(F.lit("x"), "customer_id")).otherwise(
                    F.col("customer_id")
                ),
            }
        )

    def _stored(self, label: str, build: Callable[[], DataFrame]) -> DataFrame:
        return stored_once(self._spark, label, self._sf_dir, build)

    @cached_property
    def monthly(self) -> DataFrame:
        return self._stored("moved_monthly", lambda: rfm.monthly_transactions(self.earlier))

    @cached_property
    def rfm(self) -> DataFrame:
        return self._stored("moved_rfm", lambda: rfm.rfm_of_months(self.monthly, self.rules))

    @cached_property
    def grain(self) -> DataFrame:
        return self._stored(
            "moved_grain", lambda: snapshot.composite_grain(self.earlier, self.rules)
        )


def _grain_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _State(spark, sf_dir).facts().select(*rfm.GRAIN)


def _grain_incremental_affected(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = _MovedState(spark, sf_dir)
    return incremental.grain_incremental(
        state.grain, state.filtered, state.rules, "affected_customers"
    )


def _rfm_incremental_affected(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = _MovedState(spark, sf_dir)
    return reported(
        incremental.rfm_of_affected(state.rfm, state.monthly, state.filtered, state.rules)
    )


def _rfm_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reported(_State(spark, sf_dir).facts())


# -- the versioned store: its folder is made once, each query stages a version on top of it --

_STORES: dict[tuple[str, ...], str] = {}


def _store(
    spark: SparkSession, sf_dir: str, label: str, lines: Callable[[], DataFrame]
) -> StateStore:
    key = (spark.sparkContext.applicationId, label, sf_dir)
    made = key in _STORES
    path = _STORES.setdefault(key, scratch_path(spark, label))
    store = StateStore(spark, path, STAR_RULES)
    if not made:
        store.start(lines())
    return store


def _clean_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_tables(spark, sf_dir).txn_enriched.drop("rn")


def _store_look_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The store holds the lines dated before the increment; the others come as a batch."""
    lines = _clean_lines(spark, sf_dir)
    old = F.coalesce(F.col("invoice_date") < F.lit(INCREMENT_FROM), F.lit(False))
    store = _store(spark, sf_dir, "store_by_date", lambda: lines.where(old))
    return reported(store.staged(lines.where(~old)).snapshot().read("customer_rfm"))


def _store_affected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of some keys of the last months the store knows an older date or another customer, of
    some nothing; their lines come as a batch."""
    lines = _clean_lines(spark, sf_dir)
    key = F.pmod(F.xxhash64("invoice_no", "stock_code"), F.lit(97))
    late = F.coalesce(F.col("invoice_date") >= F.lit("2001-04-01"), F.lit(False))
    differ = late & (key < 3)
    earlier = lines.where(~(late & (key == 1))).withColumns(
        {
            "invoice_date": F.when(
                late & (key == 0), F.col("invoice_date") - F.expr("INTERVAL 61 DAYS")
            ).otherwise(F.col("invoice_date")),
            "customer_id": F.when(
                late & (key == 2), F.concat(F.lit("x"), "customer_id")
            ).otherwise(F.col("customer_id")),
        }
    )
    store = _store(spark, sf_dir, "store_moved", lambda: earlier)
    current = store.staged(lines.where(differ), "affected_customers").snapshot()
    return reported(current.read("customer_rfm"))


# Buckets of the keys of a star-schema folder: eight, or so many that a task has about a quarter
# million lines of the folder in its bucket.
STAR_BUCKETS, LINES_PER_BUCKET = 8, 250_000


def _second_load(spark: SparkSession, sf_dir: str) -> tuple[KeyStore, Snapshot]:
    """The later lines were loaded first, so that many of them give way to the earlier ones."""
    raw = lakehouse(spark, sf_dir).raw
    early = F.coalesce(F.col("invoice_date") < F.lit(INCREMENT_FROM), F.lit(False))
    key = (spark.sparkContext.applicationId, "key_store", sf_dir)
    made = key in _STORES
    # The count comes from the files' footers.
    buckets = STAR_BUCKETS if made else max(STAR_BUCKETS, raw.count() // LINES_PER_BUCKET)
    store = KeyStore(spark, _STORES.setdefault(key, scratch_path(spark, "key_store")), buckets)
    if not made:
        store.add(raw.where(~early))
    return store, store.staged(raw.where(early)).snapshot()


def _store_key_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, at = _second_load(spark, sf_dir)
    return reported(store.flags(at))


def _store_key_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, at = _second_load(spark, sf_dir)
    return reported(store.duplicate_groups(at))


def _store_key_uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, at = _second_load(spark, sf_dir)
    return reported(store.uniqueness(at=at))


# -- checks --------------------------------------------------------------------

CHECK_KINDS = (
    "not_null",
    "unique",
    "accepted_values",
    "relationships",
    "expression",
    "unique_combination",
    "at_least_one",
    "equal_row_count",
)

# Every declared check of a kind; two more comparisons beside the declared one.
CHECK_QUERIES: dict[str, list[checks.Check]] = {
    f"check_{kind}": [c for c in suite.all_checks(STAR_RULES) if c.kind == kind]
    for kind in CHECK_KINDS
}
CHECK_QUERIES["check_equal_rowcount"] = CHECK_QUERIES.pop("check_equal_row_count") + [
    checks.equal_row_count("txn_enriched", "txn_filtered"),
    checks.equal_row_count("composite_grain", "customer_rfm"),
]
CHECK_QUERIES["check_results"] = suite.all_checks(STAR_RULES)


# The line-sized tables in the order they are built, last first, and what each is built from.
BUILT_FROM = {
    "customer_rfm": "txn_filtered",
    "composite_grain": "customer_activity_months",
    "customer_activity_months": "txn_filtered",
    "txn_filtered": "txn_enriched",
    "txn_enriched": "txn_deduplicated",
    "txn_deduplicated": "",
}
PROJECTIONS = ("txn_filtered", "txn_enriched")
# Tables made of ``scanned_counts``.
COUNTED = {"dq_completeness", "dq_validity", "dq_consistency", "dq_summary"}


def tables_read_once(found: list[checks.Check]) -> frozenset[str]:
    """Tables that these checks, and the other tables they read, scan once."""
    reads = Counter(table for part in checks.parts(found) for table in part)
    for table, base in BUILT_FROM.items():
        reads[base] += reads[table] if table in PROJECTIONS else min(reads[table], 1)
    once = {t for t in BUILT_FROM if t not in PROJECTIONS and reads[t] == 1}
    return frozenset(once | ({"scanned_counts"} if len(COUNTED & set(reads)) == 1 else set()))


def _check(name: str) -> Query:
    found = CHECK_QUERIES[name]
    once = tables_read_once(found)
    return lambda spark, sf_dir: reported(
        checks.verdicts(checks.results(found, stored_tables(spark, sf_dir, once)))
    )


def _assertion(id: str) -> Query:
    return _over(lambda house: assertions.outcome(id, house, house.rules))


def queries() -> dict[str, Query]:
    bounds = lambda house: snapshot.customer_bounds(house.txn_filtered)
    out: dict[str, Query] = {
        "ingest_timestamp_coerce": _timestamp_coerce,
        "ingest_date_orders": _date_orders,
        "ingest_quoted_records": _quoted_records,
        "ingest_verification": _over(lambda h: ingest.verify_load(h.raw)),
        "stg_cleaned": _table("stg_cleaned"),
        "txn_deduplicated": _table("txn_deduplicated"),
        "txn_enriched": _table("txn_enriched"),
        "txn_filtered": _table("txn_filtered"),
        "customer_activity_months": _table("customer_activity_months"),
        "dim_months": _over(lambda h: calendar.with_line_counts(h.dim_months, h.raw)),
        "customer_base": _over(bounds),
        "customer_month_spine": _over(lambda h: snapshot.month_spine(bounds(h), h.rules)),
        "first_month_index": _over(lambda h: snapshot.first_month_index(bounds(h), h.rules)),
        "grain_full": _table("composite_grain"),
        "grain_incremental": _grain_incremental,
        "grain_incremental_affected": _grain_incremental_affected,
        "txn_monthly": _over(lambda h: rfm.monthly_transactions(h.txn_filtered)),
        "rfm_full": _table("customer_rfm"),
        "rfm_incremental": _rfm_incremental,
        "rfm_incremental_affected": _rfm_incremental_affected,
        "store_look_back": _store_look_back,
        "store_affected": _store_affected,
        "store_key_flags": _store_key_flags,
        "store_key_groups": _store_key_groups,
        "store_key_uniqueness": _store_key_uniqueness,
        "dq_completeness_flags": _over(lambda h: quality.completeness_flags(h.raw)),
        "dq_completeness": _table("dq_completeness"),
        "dq_validity_flags": _over(lambda h: quality.validity_flags(h.raw, h.rules)),
        "dq_validity": _table("dq_validity"),
        "dq_uniqueness_groups": _over(lambda h: quality.duplicate_groups(h.raw)),
        "dq_uniqueness": _table("dq_uniqueness"),
        "dq_consistency": _table("dq_consistency"),
        "dq_summary": _table("dq_summary"),
        "dq_overall_score": _over(lambda h: scorecard.overall_score(h.raw, h.rules)),
        "dq_export": _over(lambda h: scorecard.export_rows(h.dq_summary)),
        "dq_row_ids": _over(lambda h: rowflags.with_row_id(h.spark, h.raw)),
        "dq_row_flag_details": _over(lambda h: rowflags.flag_rows(h.spark, h.raw, h.rules)),
        "dq_row_level_flags": _table("dq_row_level_flags"),
        "dq_numbered_row_flags": _over(
            lambda h: rowflags.numbered_row_flags(h.spark, h.raw, h.rules)
        ),
        "dq_usable_summary": _table("dq_usable_summary"),
    }
    out.update({name: _check(name) for name in CHECK_QUERIES})
    out.update({f"assert_{id}": _assertion(id) for id in assertions.ASSERTIONS})
    return out
