"""The two facts as stored state that moves with its input.

Five tables of a versioned store change together: the deduplicated lines by month, a
fingerprint of each month, the monthly totals by month, carry-in balances as of a closed month,
and the two facts by snapshot month. An increment finds the months whose lines changed, rebuilds
the totals of those alone, and takes the facts of the open months from the balances and the
open totals. Everything it writes shows at once, when the version is published.

Changed months are found by key, for a batch of new lines (``apply``: a later line of a key
takes the earlier one's place, wherever that stands), or by fingerprint, for a whole new table
(``refresh``). ``look_back`` reprocesses the snapshots from one month before the latest,
``affected_customers`` those of every customer whose monthly totals changed, from the month after
the last one that is as it was; the latter gives the rows of a full refresh.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillgrain.operators import balances, dedup, rfm, staging
from tillgrain.operators.snapshot import LOOK_BACK_MONTHS, replace_customers
from tillgrain.plans.incremental import MODES
from tillgrain.rules import ROW_KEY, CleanRules
from tillgrain.sources.tables import materialise
from tillgrain.sources.versions import Commit, Snapshot, VersionedStore

FACTS = ("composite_grain", "customer_rfm")
NEVER = date(1900, 1, 1)


def _shifted(month: date, months: int) -> date:
    at = month.year * 12 + month.month - 1 + months
    return date(at // 12, at % 12 + 1, 1)


def _month(text: str | None) -> date | None:
    return None if text is None else date.fromisoformat(text)


def _day(month: date):
    return F.lit(month.isoformat()).cast("date")


def _keys_match(left: DataFrame, right: DataFrame):
    same = [left[k].eqNullSafe(right[f"_{k}"]) for k in ROW_KEY]
    return same[0] & same[1]


def _keys(lines: DataFrame) -> DataFrame:
    return lines.select(*[F.col(k).alias(f"_{k}") for k in ROW_KEY]).distinct()


def fingerprints(lines: DataFrame) -> DataFrame:
    """Rows and a hash sum per month: equal for equal rows in any order."""
    columns = sorted(c for c in lines.columns if c != "txn_month")
    # As decimals: a sum of 64-bit hashes would overflow.
    return lines.groupBy("txn_month").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(F.xxhash64(*columns).cast("decimal(20,0)")).alias("hash_sum"),
    )


class StateStore:
    """``lines`` everywhere are staged, enriched and one per key; the logic filter comes after."""

    def __init__(self, spark: SparkSession, root: str, rules: CleanRules) -> None:
        self.spark, self.rules = spark, rules
        self.store = VersionedStore(spark, root)

    def latest(self) -> Snapshot:
        found = self.store.latest()
        if found is None:
            raise ValueError("the store holds no version yet: begin with start()")
        return found

    def facts(self) -> tuple[DataFrame, DataFrame]:
        """Grain and RFM of one and the same version."""
        at = self.latest()
        return at.read(FACTS[0]), at.read(FACTS[1])

    # -- what is written -----------------------------------------------------

    def start(self, lines: DataFrame) -> Snapshot:
        """First version, or a full refresh on top of what is there."""
        commit = self.store.begin(self.store.latest())
        lines = balances.month_column(lines)
        stored = commit.write("lines", lines, "txn_month")
        commit.write("fingerprints", fingerprints(stored))
        kept = staging.keep_logical(stored)
        totals = commit.write("totals", balances.totals_of(kept), "txn_month")
        facts = commit.write(FACTS[1], rfm.rfm_of_months(totals, self.rules), "snapshot_date")
        commit.write(FACTS[0], facts.select(*rfm.GRAIN), "snapshot_date", clustered=True)
        closed = self._look_back(commit.snapshot())
        self._write_balances(commit, balances.before(_day(closed), totals), closed)
        return commit.publish()

    def apply(self, batch: DataFrame, mode: str = "look_back") -> Snapshot:
        """Publish the version after a batch of lines, new ones and ones of known keys."""
        return self.staged(batch, mode).publish()

    def refresh(self, lines: DataFrame, mode: str = "look_back") -> Snapshot:
        """Publish the version for a whole new table of lines."""
        base = self.latest()
        lines = balances.month_column(lines).select(*base.read("lines").columns)
        known = base.read("fingerprints").select(
            F.col("txn_month").alias("_month"), F.col("n_lines").alias("_n"), F.col("hash_sum").alias("_h")
        )
        now = fingerprints(lines)
        same = F.col("n_lines").eqNullSafe(F.col("_n")) & F.col("hash_sum").eqNullSafe(F.col("_h"))
        changed = now.join(known, F.col("txn_month").eqNullSafe(F.col("_month")), "full").where(~same)
        # At most one row per month. A month that vanished is known from the old side.
        touched = [
            r[0] for r in changed.select(F.coalesce("txn_month", "_month")).distinct().collect()
        ]
        return self._staged_months(base, touched, lines.where(_within(touched)), mode).publish()

    def staged(self, batch: DataFrame, mode: str = "look_back") -> Commit:
        """What ``apply`` publishes, written and readable but not switched to."""
        base = self.latest()
        names = base.read("lines").columns
        fresh = materialise(
            self.spark, balances.month_column(batch).select(*names), "state_batch"
        )
        keys = _keys(fresh)
        low, high = fresh.agg(F.min("invoice_no"), F.max("invoice_no")).first()
        stored = base.read("lines")
        # Row groups outside the batch's invoice numbers are skipped by their statistics.
        near = stored.where(F.col("invoice_no").between(low, high) | F.col("invoice_no").isNull())
        known = near.join(keys, _keys_match(near, keys), "left_semi")
        known = materialise(self.spark, known, "state_known")
        won = dedup.keep_latest(known.unionByName(fresh)).select(*names)
        won = materialise(self.spark, won, "state_won")
        moves = known.withColumn("_n", F.lit(-1)).unionByName(won.withColumn("_n", F.lit(1)))
        differ = moves.groupBy(*names).agg(F.sum("_n").alias("_n")).where("_n != 0")
        touched = [r[0] for r in differ.select("txn_month").distinct().collect()]
        kept = base.read("lines", only=_texts(touched))
        kept = kept.join(keys, _keys_match(kept, keys), "left_anti")
        lines = kept.unionByName(won.where(_within(touched)))
        return self._staged_months(base, touched, lines, mode)

    # -- one increment ---------------------------------------------------------

    def _staged_months(
        self, base: Snapshot, touched: Sequence[date | None], lines: DataFrame, mode: str
    ) -> Commit:
        """The version in which ``lines`` are those of the touched months."""
        if mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}")
        commit = self.store.begin(base)
        if not touched:
            return commit
        texts = _texts(touched)
        commit.write("lines", lines, "txn_month", replaces=texts)
        fresh = commit.snapshot().read("lines", only=texts)
        marks = base.read("fingerprints").where(~_within(touched))
        commit.write("fingerprints", marks.unionByName(fingerprints(fresh)))
        totals = balances.totals_of(staging.keep_logical(fresh))
        commit.write("totals", totals, "txn_month", replaces=texts)
        changed = materialise(
            self.spark,
            _changed(base.read("totals", only=texts), commit.snapshot().read("totals", only=texts)),
            "state_changed",
        )
        dated = [m for m in touched if m is not None]
        if mode == "look_back":
            closed = self._look_back(base)
            self._carry_forward(commit, base, changed, dated, closed)
            self._rewrite_open(commit, base, closed)
        else:
            closed = _as_of(base)
            if any(m < closed for m in dated):
                self._carry_forward(commit, base, changed, dated, closed)
            self._rewrite_affected(commit, base, changed)
        return commit

    def _look_back(self, at: Snapshot) -> date:
        """First month an incremental run reprocesses; by partition names, without a job."""
        months = [m for m in at.partitions(FACTS[1]) if m is not None]
        return _shifted(_month(max(months)) if months else NEVER, -LOOK_BACK_MONTHS)

    def _write_balances(self, commit: Commit, balance: DataFrame, closed: date) -> DataFrame:
        """Balances of the months before ``closed``, which the folder's name tells."""
        return commit.write("balances", balance.withColumn("as_of", _day(closed)), "as_of")

    def _carry_forward(
        self, commit: Commit, base: Snapshot, changed: DataFrame, dated: list[date], closed: date
    ) -> None:
        """Balances as of ``closed``: the old ones, the months closed since, and again from
        all totals for customers whose closed months changed."""
        now = commit.snapshot()
        was = _as_of(base)
        if closed < was:
            old = now.read("totals", only=_months_before(now, closed))
            self._write_balances(commit, balances.merged(balances.of_totals(old)), closed)
            return
        parts = [base.read("balances")]
        if any(m < was for m in dated):
            late = changed.where(F.col("txn_month") < _day(was)).select("customer_id").distinct()
            old = now.read("totals", only=_months_before(now, was))
            again = old.join(late, "customer_id", "left_semi")
            parts = [parts[0].join(late, "customer_id", "left_anti"), balances.of_totals(again)]
        since = [m for m in _months_before(now, closed) if _month(m) >= was]
        if since:
            parts.append(balances.of_totals(now.read("totals", only=since)))
        if len(parts) > 1 or closed != was:
            self._write_balances(commit, balances.merged(*parts), closed)

    def _rewrite_open(self, commit: Commit, base: Snapshot, since: date) -> None:
        now = commit.snapshot()
        balance = now.read("balances")
        months = [m for m in now.partitions("totals") if m is not None and _month(m) >= since]
        opened = now.read("totals", only=months)
        replaced = self._snapshots_from(base, since)
        recent = base.read(FACTS[1], only=replaced)
        facts = balances.facts_since(balance, opened, recent, self.rules, _day(since))
        self._write_facts(commit, facts, replaced)

    def _write_facts(self, commit: Commit, facts: DataFrame, replaced: list[str]) -> None:
        commit.write(FACTS[1], facts, "snapshot_date", replaces=replaced)
        written = commit.snapshot().read(FACTS[1], only=replaced)
        grain = written.select(*rfm.GRAIN)
        commit.write(FACTS[0], grain, "snapshot_date", replaces=replaced, clustered=True)

    def _rewrite_affected(self, commit: Commit, base: Snapshot, changed: DataFrame) -> None:
        who = changed.groupBy("customer_id").agg(F.min("txn_month").alias("_from"))
        totals = commit.snapshot().read("totals").join(who, "customer_id")
        totals = materialise(self.spark, totals, "state_affected")
        # Months up to the last one before a customer's first change stay as they are.
        earlier = F.max(F.when(F.col("txn_month") < F.col("_from"), F.col("txn_month")))
        first = totals.groupBy("customer_id").agg(earlier.alias("_last"), F.min("_from").alias("_from"))
        starts = first.select(F.coalesce(F.add_months("_last", 1), "_from").alias("m")).unionByName(
            who.select(F.col("_from").alias("m"))
        )
        low = starts.agg(F.min("m")).first()[0]
        if low is None:
            return
        replaced = self._snapshots_from(base, low)
        rebuilt = rfm.rfm_of_months(totals.drop("_from"), self.rules)
        rebuilt = rebuilt.where(F.col("snapshot_date") >= _day(low))
        customers = who.select("customer_id")
        facts = replace_customers(base.read(FACTS[1], only=replaced), customers, rebuilt)
        self._write_facts(commit, facts, replaced)

    def _snapshots_from(self, base: Snapshot, since: date) -> list[str]:
        """Snapshot months from ``since`` on, in the facts or in the month dimension."""
        high = date.fromisoformat(self.rules.end_month)
        month, out = max(since, date.fromisoformat(self.rules.first_month)), set()
        while month < high:
            out.add(month.isoformat())
            month = _shifted(month, 1)
        known = [m for name in FACTS for m in base.partitions(name) if m is not None]
        return sorted(out | {m for m in known if _month(m) >= since})


def _texts(months: Sequence[date | None]) -> list[str | None]:
    return [None if m is None else m.isoformat() for m in months]


def _within(months: Sequence[date | None]):
    """Whether a row's month is one of these, the unknown month included."""
    named = [m for m in months if m is not None]
    inside = F.col("txn_month").isin(named) if named else F.lit(False)
    inside = F.coalesce(inside, F.lit(False))
    return inside | F.col("txn_month").isNull() if None in months else inside


def _months_before(at: Snapshot, month: date) -> list[str]:
    return [m for m in at.partitions("totals") if m is not None and _month(m) < month]


def _as_of(at: Snapshot) -> date:
    """Month that the balances stop before; without any balance, one before all months."""
    return _month((at.partitions("balances") or [NEVER.isoformat()])[0])


def _changed(before: DataFrame, after: DataFrame) -> DataFrame:
    """(customer_id, txn_month) whose totals differ, unknown months aside."""
    key = ["customer_id", "txn_month"]
    old = before.where("txn_month IS NOT NULL").select(
        *key, *[F.col(c).alias(f"_{c}") for c in balances.TOTALS]
    )
    new = after.where("txn_month IS NOT NULL").select(*key, *balances.TOTALS)
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in balances.TOTALS]
    return old.join(new, key, "full").where(~(same[0] & same[1] & same[2])).select(*key)
