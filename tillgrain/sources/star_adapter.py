"""Raw retail lines derived from an order/line-item star schema.

Gives the pipeline an input of any size with every kind of defect the quality
rules look for. A defect is placed by the remainder of a per-line number, in the
order the branches are listed, so SQL can rebuild the same table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillgrain.rules import COUNTRIES, CleanRules
from tillgrain.sources.tables import stored_once

# Dates of the star schema span 1995-2001; "now" is fixed so results are stable.
STAR_RULES = CleanRules(
    as_of="2026-01-01 00:00:00", first_month="1995-01-01", end_month="2002-01-01"
)


def _padded(key: Column, width: int) -> Column:
    text = key.cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def _case(branches: list[tuple[Column, Column]], default: Column) -> Column:
    out = F
    for condition, value in branches:
        out = out.when(condition, value)
    return out.otherwise(default)


def _spread(spark: SparkSession, scan: DataFrame) -> DataFrame:
    """Use all cores on a source of fewer splits than cores; leave larger ones alone."""
    cores = spark.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def stored_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw lines as a stored table: the pipeline starts where an ingest ends."""
    return stored_once(spark, "raw", sf_dir, lambda: raw_lines(spark, sf_dir))


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    # Orders meet their customers first, so that lines are dealt by order and by part alone.
    placed = table("orders").join(table("customer"), F.col("o_custkey") == F.col("c_custkey"))
    joined = (
        _spread(spark, table("lineitem"))
        .join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table("part"), F.col("l_partkey") == F.col("p_partkey"))
    )
    h = F.col("l_orderkey") * 31 + F.col("l_partkey") * 17 + F.col("l_linenumber") * 7
    every = lambda n: h % n == 0
    null = F.lit(None)
    invoice = _padded(F.col("l_orderkey"), 6)
    sku = F.concat(F.lit("P"), _padded(F.col("l_partkey"), 5))
    returned = (F.col("l_returnflag") == "R") & (F.col("l_orderkey") % 5 == 0)
    customer = F.concat(F.col("o_custkey").cast("string"), F.lit(".0"))
    quantity, price = F.col("l_quantity"), F.col("p_retailprice")
    nation = F.col("c_nationkey")
    minutes = F.make_dt_interval(mins=(F.col("l_linenumber") * 37 + 480).cast("int"))
    ordered = F.col("o_orderdate").cast("timestamp_ntz")
    future = F.lit("2999-01-01 00:00:00").cast("timestamp_ntz")
    listed = F.element_at(F.array(*[F.lit(c) for c in COUNTRIES]), nation.cast("int") + 1)

    return joined.select(
        _case(
            [
                (every(211), null),
                (every(197), F.lit("")),
                (every(193), F.concat(F.lit("A"), invoice)),
                (returned, F.concat(F.lit("C"), invoice)),
                (every(101), F.concat(F.lit(" "), invoice, F.lit(" "))),
            ],
            invoice,
        ).alias("invoice_no"),
        _case(
            [
                (every(223), null),
                (every(199), F.lit("")),
                (every(181), F.concat(sku, F.lit("-X"))),
            ],
            sku,
        ).alias("stock_code"),
        _case(
            [
                (every(13), null),
                (every(179), F.lit("???")),
                (every(173), F.concat(F.lit("aaAAa "), F.col("p_name"))),
                (every(167), F.lit("---")),
            ],
            F.col("p_name"),
        ).alias("description"),
        _case(
            [
                (every(227), null),
                (every(163), F.lit(0.0)),
                (every(157), quantity * 1000),
                (every(151), quantity + 0.5),
                (returned, -quantity),
            ],
            quantity,
        ).alias("quantity"),
        _case([(every(229), null), (every(149), future)], ordered + minutes).alias(
            "invoice_date"
        ),
        _case(
            [
                (every(139), null),
                (every(137), -price),
                (every(131), F.lit(0.0)),
                (every(127), price + 0.001),
                (every(113), F.lit(100000.0)),
            ],
            price,
        ).alias("unit_price"),
        _case(
            [
                (F.col("l_orderkey") % 17 == 0, null),
                (every(109), F.concat(F.lit(" "), customer)),
            ],
            customer,
        ).alias("customer_id"),
        _case(
            [
                (every(103), null),
                (every(97), F.lit("")),
                (every(107), F.lit(" France")),
                (nation == 22, F.lit("Unspecified")),
                (nation == 23, F.lit("Nigeria")),
                (nation == 24, F.lit("U.S.A.")),
            ],
            listed,
        ).alias("country"),
    )
