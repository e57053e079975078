"""Dates written with slashes: day first or month first, told per file by its own dates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Formats tried after ISO text, in this order; the month comes first.
DATE_FORMATS = ("M/d/yyyy H:mm:ss", "M/d/yyyy H:mm", "M/d/yyyy", "yyyy/M/d H:mm", "d.M.yyyy H:mm")
DAY_FIRST_FORMATS = tuple(f.replace("M/d/", "d/M/") for f in DATE_FORMATS)
_DAY = r"^\s*[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"
_SLASHED = r"^\s*([0-9]{1,2})/([0-9]{1,2})/[0-9]{4}"


def parse_timestamp(text: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """ISO text with a day, or one of the formats, to a zone-less timestamp; else NULL."""
    parsed = [F.when(text.rlike(_DAY), text).try_cast("timestamp_ntz")]
    parsed += [F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in formats]
    return F.coalesce(*parsed)


def date_orders(rows: DataFrame, text: str, file: str) -> DataFrame:
    """(file, date_order, ambiguous_dates): one row per file.

    A date whose first number is above 12 can only be day first, one whose second number is
    can only be month first. ``date_order`` is ``day_first`` or ``month_first`` where only
    such dates of one kind exist, ``mixed`` where both do, ``undecided`` where no date tells,
    ``none`` without dates in slashes. ``ambiguous_dates`` fit both orders.
    """
    first, second = (
        F.regexp_extract(text, _SLASHED, group).try_cast("int") for group in (1, 2)
    )
    month, day = (lambda x: x.between(1, 12)), (lambda x: x.between(13, 31))
    counts = rows.groupBy(file).agg(
        F.count_if(day(first) & month(second)).alias("_day_first"),
        F.count_if(month(first) & day(second)).alias("_month_first"),
        F.count_if(month(first) & month(second)).alias("ambiguous_dates"),
    )
    days, months = F.col("_day_first") > 0, F.col("_month_first") > 0
    order = (
        F.when(days & months, "mixed")
        .when(days, "day_first")
        .when(months, "month_first")
        .when(F.col("ambiguous_dates") > 0, "undecided")
        .otherwise("none")
    )
    return counts.select(file, order.alias("date_order"), "ambiguous_dates")


def parse_by_file(rows: DataFrame, text: str, file: str, orders: DataFrame) -> DataFrame:
    """``rows`` with ``date_order`` and ``parsed``; month first unless the file says otherwise.

    ``orders`` should be stored or cached and computed: then its size, a row per file, decides
    on a broadcast before the rows are dealt by file, of which one may hold most of them.
    """
    known = rows.join(orders.select(file, "date_order"), file)
    parsed = F.when(
        F.col("date_order") == "day_first", parse_timestamp(F.col(text), DAY_FIRST_FORMATS)
    ).otherwise(parse_timestamp(F.col(text)))
    return known.withColumn("parsed", parsed)
