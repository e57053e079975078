"""CSV ingest, import log, load check, stored layers and export."""

from __future__ import annotations

import csv
import io
import random
from datetime import datetime

import pytest
from conftest import RULES
from pyspark.sql import functions as F

from tillgrain.operators import rowflags, scorecard
from tillgrain.plans import incremental, pipeline
from tillgrain.rules import RAW_COLUMNS
from tillgrain.sources import dates, ingest
from tillgrain.sources.export import export_row_flags, export_scorecard
from tillgrain.sources.records import lines, records
from tillgrain.sources.star_adapter import STAR_RULES
from tillgrain.sources.tables import merge_into_partitions, write_table
from tillgrain.sources.versions import VersionedStore

HEADER = "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country\n"
LINES = (
    '489434,85048,"15CM ""BALL"", PINK",12,2009-12-01 07:45:00,6.95,13085.0,United Kingdom\n'
    "489435,22350,CAFÉ,-1,not a date,2.55,,France\n"
    "C489436,NA,N/A,3,2009-13-45,0.5,13086.0,\n"
    "489437,22351,,4,01/12/2009 08:15,1.5,13087.0,EIRE\n"
)


@pytest.fixture
def csv_file(tmp_path):
    path = tmp_path / "retail.csv"
    path.write_bytes((HEADER + LINES).encode("latin-1"))
    return path


def test_read_and_type(spark, csv_file):
    rows = ingest.typed(
        ingest.read_csv(spark, str(csv_file)), date_formats=("dd/MM/yyyy HH:mm",)
    ).collect()
    by_invoice = {r.invoice_no: r for r in rows}
    assert rows[0].asDict().keys() == set(RAW_COLUMNS)
    first = by_invoice["489434"]
    assert first.description == '15CM "BALL", PINK'
    assert first.invoice_date == datetime(2009, 12, 1, 7, 45)
    assert (first.quantity, first.unit_price, first.customer_id) == (12.0, 6.95, "13085.0")
    assert by_invoice["489435"].description == "CAFÉ"
    assert by_invoice["489435"].invoice_date is None
    assert by_invoice["489435"].customer_id is None
    cancelled = by_invoice["C489436"]
    assert (cancelled.stock_code, cancelled.description, cancelled.country) == (None,) * 3
    assert by_invoice["489437"].invoice_date == datetime(2009, 12, 1, 8, 15)


def test_wrong_number_of_columns_fails(spark, tmp_path):
    path = tmp_path / "short.csv"
    path.write_text("a,b\n1,2\n")
    with pytest.raises(Exception, match="[Cc]olumn"):
        ingest.read_csv(spark, str(path))


def test_line_lengths(spark, tmp_path):
    path = tmp_path / "ragged.csv"
    path.write_text(HEADER + "1,A,X,1,2009-12-01,1\n")
    row = ingest.read_csv(spark, str(path)).first()
    assert (row.invoice_no, row.customer_id, row.country) == ("1", None, None)
    path.write_text(HEADER + "1,A,X,1,2009-12-01,1,1,France,surplus\n")
    with pytest.raises(Exception, match="more than 8 values"):
        ingest.read_csv(spark, str(path)).collect()


def test_quoted_line_breaks(spark, tmp_path):
    path = tmp_path / "broken.csv"
    path.write_text(HEADER + '1,A,X,1,2009-12-01,1,1,"United\nKingdom"\n2,B,Y,1,2009-12-01,1,1,France\n')
    with pytest.raises(Exception, match="multi_line"):
        ingest.read_csv(spark, str(path), multi_line=False).collect()
    rows = ingest.read_csv(spark, str(path)).orderBy("invoice_no").collect()
    assert [r.country for r in rows] == ["United\nKingdom", "France"]
    path.write_text(HEADER + '1,A,X,1,2009-12-01,1,1,"United\nKingdom\n2,B,Y,1,2009-12-01,1,1,France\n')
    with pytest.raises(Exception, match="quote without its other end in .*broken.csv"):
        ingest.read_csv(spark, str(path)).collect()


@pytest.fixture
def small_blocks(spark):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    yield lambda size: spark.conf.set(name, size)
    spark.conf.set(name, before)


@pytest.mark.parametrize("size", [7, 40, 300, 100_000])
def test_records_over_blocks_match_a_reader_of_the_whole_file(spark, tmp_path, small_blocks, size):
    rng = random.Random(size)
    pieces = ["a", "é", '"', "\n", ",", " ", "bc", '6" RULER', "\n\n", '""']
    expected = []
    for k in range(2):
        rows = [[f"h{i}" for i in range(8)]]
        for i in range(25):
            texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(4))) for _ in range(7)]
            rows.append([f"{k}-{i}", *texts])
        path = tmp_path / "in" / f"{k}.csv"
        path.parent.mkdir(exist_ok=True)
        with path.open("w", newline="", encoding="latin-1") as handle:
            for n, row in enumerate(rows):
                # A field that neither begins with a quote nor needs one stands as it is.
                plain = [x and x[0] != '"' and not set(x) & {",", "\n"} for x in row]
                cells = [x if bare else '"' + x.replace('"', '""') + '"' for x, bare in zip(row, plain)]
                handle.write(",".join(cells) + ("\n\n" if n % 9 == 5 else "\n"))
        expected += rows[1:]
    small_blocks(size)
    folder = str(tmp_path / "in")
    assert (lines(spark, folder).select("file", "block").distinct().count() > 2) == (size < 1000)
    cut = records(lines(spark, folder)).where("not (block = 0 and number = 1)")
    got = sorted(next(csv.reader(io.StringIO(r.text, newline=""))) for r in cut.collect())
    assert got == sorted(expected)
    values = {tuple(r) for r in ingest.read_csv(spark, folder).fillna("").collect()}
    assert {v[0] for v in values} == {r[0] for r in expected}
    inner = {r[0]: r[2] for r in expected if r[2].strip() == r[2] and r[2]}
    found = {v[0]: v[2] for v in values}
    assert all(found[k] == x for k, x in inner.items())


def test_records_of_empty_and_header_only_files(spark, tmp_path):
    path = tmp_path / "header.csv"
    path.write_text(HEADER)
    assert ingest.read_csv(spark, str(path)).isEmpty()
    path.write_bytes((HEADER + "1,A,X,1,2009-12-01,1,1,France\n").replace("\n", "\r\n").encode())
    assert [tuple(r) for r in ingest.read_csv(spark, str(path)).collect()] == [
        ("1", "A", "X", "1", "2009-12-01", "1", "1", "France")
    ]


def _dated(folder, name, texts):
    folder.mkdir(exist_ok=True)
    body = "".join(f"{name}{i},A,X,1,{d},1,1,France\n" for i, d in enumerate(texts))
    (folder / f"{name}.csv").write_text(HEADER + body)
    return str(folder / f"{name}.csv")


def test_order_of_day_and_month_is_told_per_file(spark, tmp_path):
    folder = tmp_path / "in"
    _dated(folder, "d", ["3/2/2010 8:26", "25/12/2010 8:26", "12/31/20 8:26"])
    _dated(folder, "m", ["3/2/2010 8:26", "12/25/2010 8:26", "99/99/2010 8:26"])
    _dated(folder, "i", ["2010-02-03 08:26:00", "no date"])
    raw_path, log_path = str(tmp_path / "raw"), str(tmp_path / "log")
    load = ingest.ingest_csv(spark, str(folder), raw_path, log_path)
    got = {r.invoice_no: r.invoice_date for r in load.raw.collect()}
    assert got["d0"] == got["i0"] == datetime(2010, 2, 3, 8, 26)
    assert got["m0"] == datetime(2010, 3, 2, 8, 26)
    assert got["d1"] == got["m1"] == datetime(2010, 12, 25, 8, 26)
    assert got["d2"] is got["m2"] is got["i1"] is None
    (log,) = load.log.collect()
    assert (log.date_order, log.ambiguous_dates) == ("day_first,month_first,none", 0)
    assert (log.row_count, log.unparsed_dates) == (8, 3)


def test_undecided_and_mixed_files_are_logged(spark, tmp_path):
    raw_path, log_path = str(tmp_path / "raw"), str(tmp_path / "log")
    # A log line of before these columns.
    old = spark.sql("select uuid() as id, now() as import_timestamp, 'old' as filename, 1L as row_count")
    old.write.parquet(log_path)
    for name, texts in (
        ("undecided", ["3/2/2010", "12/12/2010"]),
        ("mixed", ["25/12/2010", "12/25/2010", "3/2/2010"]),
    ):
        ingest.ingest_csv(spark, _dated(tmp_path / "in", name, texts), raw_path, log_path)
    load = ingest.ingest_csv(
        spark, str(tmp_path / "in" / "mixed.csv"), raw_path, log_path, ["d/M/yyyy"]
    )
    got = {(r.filename, r.date_order): (r.ambiguous_dates, r.unparsed_dates) for r in load.log.collect()}
    assert got == {
        ("old", None): (None, None),
        ("undecided.csv", "undecided"): (2, 0),
        ("mixed.csv", "mixed"): (1, 1),
        ("mixed.csv", None): (None, 1),
    }


def test_inch_marks_are_text(spark, tmp_path):
    path = tmp_path / "inch.csv"
    lines = ['1,A,6" RULER,1,2009-12-01,1,1,France', '2,B,"6"" RULER, WOOD",1,2009-12-01,1,1,"France"']
    lines += ['3,C,TAPE 6",1,2009-12-01,1,1,France', '4,D,"",1,2009-12-01,1,1,France']
    path.write_text(HEADER + "\n".join(lines) + "\n")
    one_line = ingest.read_csv(spark, str(path), multi_line=False)
    assert ingest.read_csv(spark, str(path)).exceptAll(one_line).isEmpty()
    rows = ingest.read_csv(spark, str(path)).orderBy("invoice_no").collect()
    assert [r.description for r in rows] == ['6" RULER', '6" RULER, WOOD', 'TAPE 6"', None]
    assert {r.country for r in rows} == {"France"}
    # Two quotes in the line do not hide the one that is open.
    path.write_text(HEADER + '1,A,6" RULER,1,2009-12-01,1,1,"United\nKingdom"\n')
    with pytest.raises(Exception, match="multi_line"):
        ingest.read_csv(spark, str(path), multi_line=False).collect()
    assert ingest.read_csv(spark, str(path)).first().country == "United\nKingdom"


def test_usual_dates_by_default(spark):
    texts = ["12/1/2010 8:26", "2010-12-01 08:26:00", "2010", "1/2/2010", "13/13/2010 8:26", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.d for r in rows.select(dates.parse_timestamp(rows.t).alias("d")).collect()]
    day = datetime(2010, 12, 1, 8, 26)
    assert got == [day, day, None, datetime(2010, 1, 2), None, None]


def test_bad_number_fails_the_load(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text(HEADER + "1,A,X,many,2009-12-01,1,1,France\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        ingest.typed(ingest.read_csv(spark, str(path))).collect()


def test_append_log_and_verify(spark, csv_file, tmp_path):
    raw_path, log_path = str(tmp_path / "raw"), str(tmp_path / "log")
    ingest.ingest_csv(spark, str(csv_file), raw_path, log_path)
    load = ingest.ingest_csv(spark, str(csv_file), raw_path, log_path)
    assert load.raw.count() == 8  # loading twice adds twice
    assert load.raw.where("imported_at IS NULL").isEmpty()
    assert load.raw.select(*RAW_COLUMNS).schema["invoice_date"].dataType.simpleString() == (
        "timestamp_ntz"
    )
    log = load.log.collect()
    assert [(r.filename, r.row_count) for r in log] == [("retail.csv", 4)] * 2
    assert len({r.id for r in log}) == 2
    assert [r.unparsed_dates for r in log] == [2, 2]
    assert log[0].file_size_mb == csv_file.stat().st_size / 1024 / 1024
    check = ingest.verify_load(load.raw).first()
    assert tuple(check) == (8, 4, 3, 3, 3)
    assert tuple(ingest.estimate_load(load.log).first()) == tuple(check)


def test_sketches_of_several_loads_unite(spark, tmp_path):
    raw_path, log_path = str(tmp_path / "raw"), str(tmp_path / "log")
    for k, ids in enumerate((range(0, 30_000), range(20_000, 50_000))):
        path = tmp_path / f"{k}.csv"
        path.write_text(HEADER + "".join(f"{i},S{i % 700},X,1,2009-12-01,1,,France\n" for i in ids))
        load = ingest.ingest_csv(spark, str(path), raw_path, log_path, multi_line=False)
    exact = ingest.verify_load(load.raw).first().asDict()
    near = ingest.estimate_load(load.log).first().asDict()
    assert exact.keys() == near.keys()
    assert near["total_records"] == 60_000 and near["unique_customers"] == 0
    for name in exact:
        assert abs(near[name] - exact[name]) <= 0.05 * exact[name], name
    # One load logged without sketches leaves the counts unknown.
    partly = load.log.withColumn("invoices_sketch", F.when(F.col("filename") == "0.csv", F.col("invoices_sketch")))
    assert ingest.estimate_load(partly).first().unique_invoices is None
    assert tuple(ingest.estimate_load(load.log.limit(0)).first()) == (0, 0, 0, 0, 0)


def test_file_sizes_read_no_content(spark, csv_file):
    plan = ingest.file_sizes(spark, str(csv_file))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_export_is_one_sorted_csv(spark, star, tmp_path):
    card = scorecard.scorecard(star.raw, star.rules)
    export_scorecard(card, str(tmp_path / "card"))
    (file,) = (tmp_path / "card").glob("*.csv")
    with file.open(newline="", encoding="utf-8") as handle:
        rows = list(csv.reader(handle))
    assert rows[0] == [
        "dimension", "check_name", "metric_name", "metric_value", "rate", "n_total"
    ]
    assert len(rows) == 25
    labels = [tuple(r[:2]) for r in rows[1:]]
    assert labels == sorted(labels)
    assert ["overall", "ALL", "dq_score", ""] == [r for r in rows if r[0] == "overall"][0][:4]


def test_scorecard_shape_and_status(star):
    card = {(r.dimension, r.check_name, r.metric_name): r for r in star.dq_summary.collect()}
    assert len(card) == 24
    rates = [r.rate for k, r in card.items() if k[0] != "overall"]
    overall = card[("overall", "ALL", "dq_score")]
    assert abs(float(sum(rates)) / 23 - float(overall.rate)) <= 0.00005 + 1e-12
    assert overall.metric_value is None and overall.n_total == 6000
    for r in card.values():
        expected = "PASS" if r.rate >= 0.99 else "WARN" if r.rate >= 0.95 else "FAIL"
        assert r.status == expected
        assert r.run_at is not None
    assert str(card[("completeness", "customer_id", "incomplete_count")].rate) == "1.0000"


def test_row_flags_are_exported_in_order(spark, star, tmp_path):
    numbered = rowflags.numbered_row_flags(spark, star.raw, RULES)
    export_row_flags(numbered, str(tmp_path / "flags"))
    files = sorted((tmp_path / "flags").glob("*.csv"))
    got = []
    for file in files:
        with open(file, newline="") as lines:
            got += [(r["invoice_no"], r["error_count"]) for r in csv.DictReader(lines)]
    want = [(r.invoice_no, str(r.error_count)) for r in numbered.sort("row_id").collect()]
    assert len(got) == 6000 and got == [(n or "", e) for n, e in want]


def _write_lines(path, *numbers, header=",".join(RAW_COLUMNS)):
    rows = [f"{n},A,MUG,1,2010-12-01 08:26:00,1.25,{n},France" for n in numbers]
    path.write_text("\n".join([header, *rows]) + "\n")


def test_each_file_is_loaded_once(spark, tmp_path, monkeypatch):
    inbox, root = tmp_path / "in", str(tmp_path / "lake")
    inbox.mkdir()
    _write_lines(inbox / "a.csv", 1, 2)
    _write_lines(inbox / "copy.csv", 2, 1)

    def held(load):
        return sorted(r.invoice_no for r in load.raw.collect()), load.log.count()

    assert held(ingest.ingest_once(spark, str(inbox), root)) == (["1", "2"], 1)
    assert held(ingest.ingest_once(spark, str(inbox), root)) == (["1", "2"], 1)
    # A run that breaks off before the log is written shows nothing; repeated, it adds its rows.
    _write_lines(inbox / "b.csv", 3, 3)
    with monkeypatch.context() as broken:
        broken.setattr(ingest, "file_sizes", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            ingest.ingest_once(spark, str(inbox), root)
    assert VersionedStore(spark, root).latest().read("raw").count() == 2
    load = ingest.ingest_once(spark, str(inbox), root)
    assert held(load) == (["1", "2", "3", "3"], 2)
    assert sorted(r.row_count for r in load.log.collect()) == [2, 2]
    assert all(r.file_size_mb > 0 for r in load.log.collect())
    assert ingest.estimate_load(load.log).first().unique_invoices == 3
    # The appending load stays as it was.
    for _ in range(2):
        plain = ingest.ingest_csv(spark, str(inbox / "a.csv"), root + "/plain", root + "/plain_log")
    assert plain.raw.count() == 4


def test_scorecard_of_an_empty_table(star):
    rows = scorecard.scorecard(star.raw.limit(0), RULES).collect()
    assert sorted(r.dimension for r in rows) == ["consistency"] * 2 + ["uniqueness"] * 2
    assert {(r.rate, r.status) for r in rows} == {(None, "FAIL")}


def test_merge_rewrites_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "facts")
    rows = [("a", 1, "old"), ("b", 1, "old"), ("a", 2, "old")]
    write_table(spark.createDataFrame(rows, "c STRING, p INT, v STRING"), path, ["p"])
    before = {f.name for f in (tmp_path / "facts" / "p=1").glob("*.parquet")}
    delta = spark.createDataFrame([("a", 2, "new"), ("z", 3, "new")], "c STRING, p INT, v STRING")
    merged = merge_into_partitions(spark, path, delta, ["c", "p"], "p")
    assert {(r.c, r.p, r.v) for r in merged.collect()} == {
        ("a", 1, "old"), ("b", 1, "old"), ("a", 2, "new"), ("z", 3, "new")
    }
    assert {f.name for f in (tmp_path / "facts" / "p=1").glob("*.parquet")} == before
    with pytest.raises(ValueError, match="partition column"):
        merge_into_partitions(spark, path, delta, ["c"], "p")


def test_build_stores_every_table_and_refreshes(spark, star, filtered, tmp_path):
    out = str(tmp_path / "lake")
    earlier = star.raw.where("invoice_date < '2000-07-01'")
    tables = pipeline.build(spark, earlier, out, STAR_RULES)
    assert set(tables) == set(pipeline.Lakehouse.NAMES)
    assert tables["dq_summary"].count() == 24
    assert tables["customer_rfm"].count() == tables["composite_grain"].count()
    old_grain = tables["composite_grain"].count()
    grain, facts = incremental.refresh_stored(spark, out, filtered, STAR_RULES)
    assert grain.count() > old_grain
    keys = ["customer_id", "snapshot_date"]
    assert grain.select(*keys).exceptAll(facts.select(*keys)).isEmpty()
    assert grain.groupBy(*keys).count().where("count > 1").isEmpty()


def test_full_build_row_counts(spark, star, tmp_path):
    tables = pipeline.build(spark, star.raw, str(tmp_path / "lake"), STAR_RULES)
    counts = {
        n: tables[n].count()
        for n in ("stg_cleaned", "txn_deduplicated", "txn_filtered", "composite_grain",
                  "customer_rfm", "dq_row_level_flags", "dim_months", "dq_usable_summary")
    }
    assert counts == {
        "stg_cleaned": 6000, "txn_deduplicated": 5941, "txn_filtered": 5842,
        "composite_grain": 9951, "customer_rfm": 9951, "dq_row_level_flags": 6000,
        "dim_months": 84, "dq_usable_summary": 1,
    }
    assert tables["composite_grain"].where("had_activity").count() == 1311
    assert tables["dq_row_level_flags"].where("error_count = 0").count() == 4381
