"""Exact rates and percentages: decimal division, half-up rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RATE = "decimal(5,4)"
PERCENT = "decimal(5,2)"


def _ratio(part: Column, whole: Column) -> Column:
    whole = F.when(whole != 0, whole).cast("decimal(18,0)")
    return part.cast("decimal(18,0)") / whole


def share(part: Column, whole: Column) -> Column:
    """part / whole to 4 places, NULL when there is nothing to divide by."""
    return F.round(_ratio(part, whole), 4).cast(RATE)


def complement_share(part: Column, whole: Column) -> Column:
    """1 - part / whole to 4 places."""
    return F.round(F.lit(1).cast("decimal(18,0)") - _ratio(part, whole), 4).cast(RATE)


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole to 2 places."""
    return F.round(F.lit(100).cast("decimal(3,0)") * _ratio(part, whole), 2).cast(PERCENT)


def banded(value: Column, bands: tuple, lowest: str) -> Column:
    """Label of the first band whose lower bound the value reaches; NULL gets ``lowest``."""
    out = F
    for bound, label in bands:
        out = out.when(value >= F.lit(bound), F.lit(label))
    return out.otherwise(F.lit(lowest))
