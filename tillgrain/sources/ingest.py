"""CSV ingest into the raw table, with an import log and a load check."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillgrain.rules import MISSING_TOKENS, RAW_COLUMNS
from tillgrain.sources.dates import (
    DATE_FORMATS,
    date_orders,
    parse_by_file,
    parse_timestamp,
)
from tillgrain.sources.records import lines, records
from tillgrain.sources.tables import materialise
from tillgrain.sources.versions import VersionedStore


_QUOTED_FIELD = r'(^|,)"[^"]*+(?:""[^"]*+)*+"(?=,|$)'


def read_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """The files' eight columns as text under their canonical names.

    Columns are named by position: a header of another length raises here, a
    line with more values when it is read. A shorter line ends in unknown
    values. Quoted fields may hold line breaks, and large files are split all the same, at
    the price of one shuffle of the lines. Without ``multi_line`` there is none, and a field
    whose opening quote is left open in its line fails the read. A quote within a field that
    does not begin with one (``6" RULER``) is part of its text.
    """
    return _read(spark, path, multi_line).drop("_file")


def _read(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    """The eight columns and the file each line is from."""
    header = spark.read.option("header", True).option("encoding", "ISO-8859-1")
    header.option("escape", '"').csv(path).toDF(*RAW_COLUMNS)
    fields = [f"{c} STRING" for c in (*RAW_COLUMNS, "_surplus")]
    if multi_line:
        body = records(lines(spark, path)).where("not (block = 0 and number = 1)")
        options = {"escape": '"', "multiLine": "true"}
        values = F.from_csv("text", ", ".join(fields), options).alias("values")
        text = body.select(F.col("file").alias("_file"), values).select("_file", "values.*")
        open_quote = F.lit(False)
    else:
        # Every line is one value short of this schema, so its own text comes along.
        reader = spark.read.option("header", True).option("encoding", "ISO-8859-1")
        reader = reader.option("escape", '"').option("columnNameOfCorruptRecord", "_line")
        text = reader.schema(", ".join([*fields, "_line STRING"])).csv(path)
        text = text.withColumn("_file", F.col("_metadata.file_path"))
        # A quote inside a field, like an inch mark, is text; one at its beginning needs its end.
        open_quote = F.regexp_replace("_line", _QUOTED_FIELD, "$1").rlike(r'(^|,)"')
    too_long = F.raise_error(F.lit(f"line with more than {len(RAW_COLUMNS)} values"))
    broken = F.raise_error(F.lit("quote without its other end: read with multi_line"))
    checked = {c: _known(c) for c in RAW_COLUMNS}
    first = RAW_COLUMNS[0]
    checked[first] = (
        F.when(F.col("_surplus").isNotNull(), too_long)
        .when(open_quote, broken)
        .otherwise(checked[first])
    )
    return text.select(*[c.alias(name) for name, c in checked.items()], "_file")


def _known(name: str) -> Column:
    return F.when(~F.col(name).isin(*MISSING_TOKENS), F.col(name))


def typed(text: DataFrame, date_formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """Raw schema. A bad date becomes NULL, a bad number fails the load."""
    return _numbers(text).withColumn(
        "invoice_date", parse_timestamp(F.col("invoice_date"), date_formats)
    )


def _numbers(text: DataFrame) -> DataFrame:
    return text.withColumns({c: F.col(c).cast("double") for c in ("quantity", "unit_price")})


# Distinct values of a load, as mergeable sketches of 2 ** 12 registers (about 1.6 % error).
SKETCH_BITS = 12
SKETCHES = {
    "invoice_no": "invoices_sketch",
    "customer_id": "customers_sketch",
    "stock_code": "products_sketch",
    "country": "countries_sketch",
}


@dataclass(frozen=True)
class Load:
    raw: DataFrame
    log: DataFrame


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, file) of the files; their content is not read. ``file`` is the path as
    other readers give it."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", "length", F.col("_metadata.file_path").alias("file"))


def ingest_csv(
    spark: SparkSession,
    path: str,
    raw_path: str,
    log_path: str,
    date_formats: Sequence[str] | None = None,
    multi_line: bool = True,
) -> Load:
    """Append the file to the raw table and one line to the import log.

    Loading a file twice adds its rows twice. The row count in the log is taken
    from the rows as they are written; so is the number of dates that no format fits.

    Unless ``date_formats`` are given, one pass over the dates tells for each file whether
    its dates in slashes put the day or the month first. The log holds the orders found
    (``date_order``, comma-joined) and, for files that are undecided or mixed and so were
    read month first, how many of their dates fit both orders (``ambiguous_dates``).
    """
    load = _Rows(spark, _read(spark, path, multi_line), date_formats)
    load.rows.write.mode("append").parquet(raw_path)
    load.log_entry(file_sizes(spark, path), path).write.mode("append").parquet(log_path)
    # Logs of earlier loads may lack the later columns.
    log = spark.read.option("mergeSchema", True).parquet(log_path)
    return Load(spark.read.parquet(raw_path), log)


class _Rows:
    """Typed rows of one load, and what is observed of them while they are written."""

    def __init__(
        self, spark: SparkSession, text: DataFrame, date_formats: Sequence[str] | None
    ) -> None:
        self._found, self._written = None, Observation()
        if date_formats is None:
            # One row per file.
            orders = materialise(spark, date_orders(text, "invoice_date", "_file"), "date_orders")
            unsure = F.col("date_order").isin("undecided", "mixed")
            self._found = orders.agg(
                F.array_join(F.sort_array(F.collect_set("date_order")), ",").alias("date_order"),
                F.coalesce(F.sum(F.when(unsure, F.col("ambiguous_dates"))), F.lit(0)).alias("n"),
            ).first()
            dated = parse_by_file(text, "invoice_date", "_file", orders)
        else:
            dated = text.withColumn("parsed", parse_timestamp(F.col("invoice_date"), date_formats))
        unparsed = F.col("invoice_date").isNotNull() & F.col("parsed").isNull()
        rows = _numbers(dated).withColumn("imported_at", F.current_timestamp()).observe(
            self._written,
            F.count(F.lit(1)).alias("row_count"),
            F.count_if(unparsed).alias("unparsed_dates"),
            *[F.hll_sketch_agg(c, SKETCH_BITS).alias(s) for c, s in SKETCHES.items()],
        )
        rows = rows.withColumn("invoice_date", F.col("parsed"))
        self.rows = rows.select(*RAW_COLUMNS, "imported_at")

    def log_entry(self, sizes: DataFrame, path: str) -> DataFrame:
        """One line for the import log, once the rows are written."""
        seen, found = self._written.get, self._found
        return sizes.agg(
            F.expr("uuid()").alias("id"),
            F.current_timestamp().alias("import_timestamp"),
            F.lit(path.rstrip("/").rsplit("/", 1)[-1]).alias("filename"),
            F.lit(seen["row_count"]).cast("bigint").alias("row_count"),
            (F.sum("length") / (1024 * 1024)).alias("file_size_mb"),
            F.lit(seen["unparsed_dates"]).cast("bigint").alias("unparsed_dates"),
            F.lit(found and found["date_order"]).cast("string").alias("date_order"),
            F.lit(found and found["n"]).cast("bigint").alias("ambiguous_dates"),
            *[F.lit(seen[s]).cast("binary").alias(s) for s in SKETCHES.values()],
        )


# -- each file once --------------------------------------------------------------


def file_digests(text: DataFrame) -> DataFrame:
    """(_file, digest) of the records of each file, whatever its name and their order.

    The digest is the number of records and the sums of two hashes of them: partial sums, so
    that a file is read in splits. Files without records have none.
    """
    sums = [
        F.sum(F.xxhash64(F.lit(seed), *RAW_COLUMNS).cast("decimal(20,0)")).cast("string")
        for seed in (1, 2)
    ]
    digest = F.concat_ws(":", F.count(F.lit(1)).cast("string"), *sums)
    return text.groupBy("_file").agg(digest.alias("digest"))


def ingest_once(
    spark: SparkSession,
    path: str,
    root: str,
    date_formats: Sequence[str] | None = None,
    multi_line: bool = True,
) -> Load:
    """Load the files that no earlier load under ``root`` holds, all of them or none.

    Raw rows, import log and the ledger of files are tables of one versioned store: they show
    together when the version is published, so a run that breaks off leaves nothing and can
    be repeated, and a rerun adds no row. A file is known by the digest of its records, not by
    its name; of equal files in one load the one of the first name is taken. A load without
    new files makes no version and no log line. ``ingest_csv`` goes on adding rows each time.
    """
    store = VersionedStore(spark, root)
    base = store.latest()
    text = _read(spark, path, multi_line)
    # One row per file.
    found = file_digests(text).groupBy("digest").agg(F.min("_file").alias("_file"))
    if base is not None:
        found = found.join(base.read("files").select("digest"), "digest", "left_anti")
    found = materialise(spark, found, "new_files")
    if base is not None and found.isEmpty():
        return Load(base.read("raw").drop("load"), base.read("log").drop("load"))
    commit = store.begin(base)
    number, own = F.lit(commit.version), [str(commit.version)]
    fresh = text.join(found.select("_file"), "_file", "left_semi").select(*text.columns)
    load = _Rows(spark, fresh, date_formats)
    commit.write("raw", load.rows.withColumn("load", number), "load", own)
    sizes = file_sizes(spark, path).join(
        found.select(F.col("_file").alias("file")), "file", "left_semi"
    )
    commit.write("log", load.log_entry(sizes, path).withColumn("load", number), "load", own)
    commit.write("files", found.withColumn("load", number), "load", own)
    at = commit.publish()
    return Load(at.read("raw").drop("load"), at.read("log").drop("load"))


def verify_load(raw: DataFrame) -> DataFrame:
    """Row total and exact distinct counts."""
    return raw.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_distinct("invoice_no").alias("unique_invoices"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.count_distinct("stock_code").alias("unique_products"),
        F.count_distinct("country").alias("unique_countries"),
    )


def estimate_load(log: DataFrame) -> DataFrame:
    """The row total, and distinct counts estimated from the sketches of all loads.

    Reads the import log alone, so it costs the same however large the raw table is. A count
    is NULL if a load was logged without sketches; without loads, total and counts are 0.
    """
    names = ("unique_invoices", "unique_customers", "unique_products", "unique_countries")
    counts = []
    for name, sketch in zip(names, SKETCHES.values(), strict=True):
        known = F.count(sketch) == F.count(F.lit(1))
        united = F.hll_sketch_estimate(F.hll_union_agg(sketch))
        counts.append(F.when(known, F.coalesce(united, F.lit(0))).alias(name))
    return log.agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("total_records"), *counts)
