"""Month arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_of(moment: Column) -> Column:
    return F.trunc(moment.cast("date"), "MM")


def month_index(month: Column) -> Column:
    return (F.year(month) * 12 + F.month(month)).cast("int")


def months_between(low: Column, high: Column) -> Column:
    """Array of month starts low..high, both included; low must not exceed high."""
    return F.sequence(low, high, F.expr("INTERVAL 1 MONTH"))


def whole_days(later: Column, earlier: Column) -> Column:
    """Complete 24-hour periods between two zone-less timestamps."""
    span = later.cast("timestamp_ntz") - earlier.cast("timestamp_ntz")
    return F.extract(F.lit("DAY"), span).cast("int")
