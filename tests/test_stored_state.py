"""Stored state: versions that switch at once, increments that touch few months."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tillgrain.operators import dedup, rfm, snapshot, staging
from tillgrain.plans import incremental
from tillgrain.plans.stored_state import FACTS, StateStore
from tillgrain.sources import versions
from tillgrain.sources.star_adapter import STAR_RULES
from tillgrain.sources.tables import materialise
from tillgrain.sources.versions import VersionedStore

CUT = "2000-07-01"


def same(a, b) -> bool:
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.fixture(scope="module")
def lines(spark, star):
    # The last 28 months and the undated lines.
    clean = staging.enrich(star.txn_deduplicated).drop("rn")
    recent = F.coalesce(F.col("invoice_date") >= F.lit("1999-09-01"), F.lit(True))
    return materialise(spark, clean.where(recent), "test_lines")


@pytest.fixture(scope="module")
def filtered_lines(spark, lines):
    return materialise(spark, staging.keep_logical(lines), "test_kept")


def full(lines):
    return rfm.rfm_full_refresh(staging.keep_logical(lines), STAR_RULES)


def is_old(cut=CUT):
    return F.coalesce(F.col("invoice_date") < F.lit(cut), F.lit(False))


def started(spark, tmp_path, lines):
    state = StateStore(spark, str(tmp_path / "state"), STAR_RULES)
    state.start(lines)
    return state


def commits(at, name):
    return dict(at.tables[name].folders)


def test_start_is_a_full_refresh(spark, tmp_path, lines):
    state = started(spark, tmp_path, lines)
    grain, facts = state.facts()
    assert same(facts, full(lines))
    assert same(grain, snapshot.composite_grain(staging.keep_logical(lines), STAR_RULES))
    assert same(state.latest().read("lines").drop("txn_month"), lines)


def test_look_back_equals_the_recomputed_one(spark, tmp_path, lines, filtered_lines):
    before = filtered_lines.where(is_old())
    state = started(spark, tmp_path, lines.where(is_old()))
    old = state.latest()
    new = state.apply(lines.where(~is_old()))
    target = materialise(spark, snapshot.composite_grain(before, STAR_RULES), "target")
    grain = materialise(
        spark, incremental.grain_incremental(target, filtered_lines, STAR_RULES), "grain"
    )
    target = materialise(spark, rfm.rfm_full_refresh(before, STAR_RULES), "target_rfm")
    assert same(new.read(FACTS[0]), grain)
    assert same(new.read(FACTS[1]), incremental.rfm_incremental(target, grain, filtered_lines))
    # Nothing before the look-back was written again, nor any old month of the lines.
    for name, since in ((FACTS[0], "2000-05"), (FACTS[1], "2000-05"), ("totals", "2000-07"), ("lines", "2000-07")):
        kept = {f: c for f, c in commits(old, name).items() if f.split("=")[1] < since}
        assert kept and kept.items() <= commits(new, name).items()
    # The next increment starts from balances of a later month.
    assert old.partitions("balances") == ["2000-05-01"]
    later = state.apply(lines.where(~is_old()))
    assert later.version == 3 and same(later.read(FACTS[1]), new.read(FACTS[1]))


def test_two_look_backs_in_a_row(spark, tmp_path, lines, filtered_lines):
    """Balances rolled forward give what balances of all totals give."""
    state = started(spark, tmp_path, lines.where(is_old("2000-02-01")))
    state.apply(lines.where(is_old() & ~is_old("2000-02-01")))
    middle = state.latest()
    new = state.apply(lines.where(~is_old()))
    assert new.partitions("balances") == ["2000-05-01"] != middle.partitions("balances")
    grain = materialise(
        spark,
        incremental.grain_incremental(middle.read(FACTS[0]), filtered_lines, STAR_RULES),
        "grain",
    )
    assert same(new.read(FACTS[0]), grain)
    expected = incremental.rfm_incremental(middle.read(FACTS[1]), grain, filtered_lines)
    assert same(new.read(FACTS[1]), expected)


def moved(lines):
    """The same keys as an earlier run knew them: some older, some under another customer,
    some not there yet."""
    key = F.xxhash64("invoice_no", "stock_code")
    return lines.where(is_old("2001-01-01") & (F.pmod(key, F.lit(41)) != 1)).withColumns(
        {
            "invoice_date": F.when(
                F.pmod(key, F.lit(37)) == 0, F.col("invoice_date") - F.expr("INTERVAL 61 DAYS")
            ).otherwise(F.col("invoice_date")),
            "customer_id": F.when(
                F.pmod(F.xxhash64("customer_id"), F.lit(31)) == 0, F.concat(F.lit("x"), "customer_id")
            ).otherwise(F.col("customer_id")),
        }
    )


def test_affected_customers_equals_a_full_refresh(spark, tmp_path, lines):
    state = started(spark, tmp_path, moved(lines))
    assert not same(state.facts()[1], full(lines))
    # All lines come again: those that are as they were change nothing.
    new = state.apply(lines, "affected_customers")
    assert same(new.read("lines").drop("txn_month"), lines)
    assert same(new.read(FACTS[1]), full(lines))
    assert same(new.read(FACTS[0]), new.read(FACTS[1]).select(*rfm.GRAIN))
    # Balances of closed months followed.
    as_of = F.lit(new.partitions("balances")[0]).cast("date")
    totals = rfm.monthly_transactions(staging.keep_logical(lines)).where(F.col("txn_month") < as_of)
    expected = totals.groupBy("customer_id").agg(
        F.min("txn_month").alias("first_month"), F.sum("txn_count").alias("txn_count")
    )
    assert same(new.read("balances").select("customer_id", "first_month", "txn_count"), expected)


def test_refresh_finds_changed_months_by_fingerprint(spark, tmp_path, lines):
    state = started(spark, tmp_path, lines)
    old = state.latest()
    gone = lines.where("customer_id is not null").orderBy("invoice_date").first()
    current = materialise(
        spark,
        lines.where(
            ~(F.col("invoice_no").eqNullSafe(F.lit(gone.invoice_no)))
        ).unionByName(
            spark.createDataFrame(
                [("999999", "P1", 2, datetime(1998, 5, 6), gone.customer_id, "France", 0)],
                "invoice_no string, stock_code string, quantity int, invoice_date timestamp_ntz,"
                " customer_id string, country string, country_invalid int",
            ).selectExpr("*", "cast(3 as decimal(10,2)) unit_price", "cast(6 as decimal(21,2)) revenue")
        ),
        "current",
    )
    new = state.refresh(current, "affected_customers")
    assert same(new.read(FACTS[1]), full(current))
    changed = {f for f, c in commits(new, "lines").items() if commits(old, "lines").get(f) != c}
    assert "txn_month=1998-05-01" in changed and len(changed) <= 3
    again = state.refresh(current, "affected_customers")
    assert again.tables == new.tables and again.version == new.version + 1


def test_late_lines_reach_balances_in_look_back(spark, tmp_path, lines):
    """A line of a long closed month counts in the metrics of the open ones."""
    state = started(spark, tmp_path, lines.where(is_old()))
    target = state.latest().read(FACTS[1])
    who = target.where("snapshot_date = '2000-06-01'").orderBy("customer_id").first()
    late = lines.where(is_old()).limit(1).withColumns(
        {
            "invoice_no": F.lit("888888"),
            "customer_id": F.lit(who.customer_id),
            "invoice_date": F.lit("1999-12-03 00:00:00").cast("timestamp_ntz"),
        }
    )
    new = state.apply(late).read(FACTS[1]).where(F.col("customer_id") == who.customer_id)
    got = {r.snapshot_date.isoformat(): r.frequency for r in new.collect()}
    assert got["2000-06-01"] == who.frequency + 1


def test_nulls_and_unknown_dates(spark, tmp_path):
    schema = (
        "invoice_no string, stock_code string, quantity int, unit_price decimal(10,2),"
        " invoice_date timestamp_ntz, customer_id string, country string, country_invalid int,"
        " revenue decimal(21,2)"
    )
    from decimal import Decimal

    def line(no, code, day, who, price="2.00"):
        price = Decimal(price)
        return (no, code, 1, price, day, who, "France", 0, price)

    first = [
        line(None, None, datetime(1999, 1, 5), "a"),
        line("1", "x", None, "a"),
        line("2", "x", datetime(1999, 3, 5), None),
        line("3", "x", datetime(1999, 2, 5), "b"),
        line("4", "x", datetime(1999, 2, 7), "b", "-1.00"),
    ]
    second = [line(None, None, datetime(1999, 4, 5), "a"), line("1", "x", datetime(1999, 6, 5), "a")]
    one, two = (spark.createDataFrame(rows, schema) for rows in (first, second))
    state = started(spark, tmp_path, one)
    new = state.apply(two, "affected_customers")
    # The unknown date of key (1, x) counts as latest; the unknown key moved to April.
    expected = dedup.keep_latest(one.unionByName(two)).drop("rn")
    assert same(new.read("lines").drop("txn_month"), expected)
    assert same(new.read(FACTS[1]), full(expected))
    with pytest.raises(ValueError, match="mode"):
        state.apply(two.limit(1).withColumn("country", F.lit("Spain")), "other")


def test_empty_start_then_all_lines(spark, tmp_path, lines):
    state = started(spark, tmp_path, lines.limit(0))
    assert state.facts()[0].isEmpty()
    for mode in incremental.MODES:
        assert same(state.staged(lines, mode).snapshot().read(FACTS[1]), full(lines))
    assert state.facts()[1].isEmpty()


def test_a_write_that_breaks_between_the_facts(spark, tmp_path, lines, monkeypatch):
    state = started(spark, tmp_path, lines.where(is_old()))
    old = state.facts()
    before = [materialise(spark, f, "before") for f in old]
    write = versions.Commit.write

    def broken(self, name, *args, **kwargs):
        if name == FACTS[0]:
            raise OSError("disk full")
        return write(self, name, *args, **kwargs)

    monkeypatch.setattr(versions.Commit, "write", broken)
    with pytest.raises(OSError, match="disk full"):
        state.apply(lines.where(~is_old()))
    monkeypatch.undo()
    # The new metrics are written, but both facts are still those of the old version.
    after = state.facts()
    assert state.latest().version == 1
    assert all(same(a, b) for a, b in zip(after, before, strict=True))
    new = state.apply(lines.where(~is_old()), "affected_customers")
    assert new.version == 2 and same(state.facts()[1], full(lines))
    # A reader that opened the old version goes on reading it.
    assert all(same(a, b) for a, b in zip(old, before, strict=True))


def test_second_writer_of_a_version_fails(spark, tmp_path):
    store = VersionedStore(spark, str(tmp_path / "store"))
    assert store.latest() is None
    one, two = store.begin(None), store.begin(None)
    one.write("t", spark.range(3))
    two.write("t", spark.range(4))
    one.publish()
    with pytest.raises(Exception, match="(?i)already exists"):
        two.publish()
    assert store.latest().read("t").count() == 3


def test_partitions_are_replaced_one_by_one(spark, tmp_path):
    store = VersionedStore(spark, str(tmp_path / "store"))
    rows = spark.sql("select id, nullif(id % 3, 2) as p from range(9)")
    first = store.begin(None)
    first.write("t", rows, "p")
    first.publish()
    second = store.begin(store.latest())
    second.write("t", rows.where("p = 0 and id > 3"), "p", replaces=["0", None])
    assert store.latest().read("t").count() == 9
    second.publish()
    at = store.latest()
    assert sorted(r.id for r in at.read("t").collect()) == [1, 4, 6, 7]
    assert at.partitions("t") == ["0", "1"] and at.read("t", only=["1"]).count() == 3
    assert at.read("t", only=[]).columns == ["id", "p"]
    with pytest.raises(ValueError, match="outside"):
        store.begin(at).write("t", rows, "p", replaces=["0"])
