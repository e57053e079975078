"""Row-level quality flags as 0/1 integer columns.

Each builder returns ``{source column: flag}`` so that aggregates and row-level
outputs share one definition and can name the flags their own way.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillgrain import rules as R
from tillgrain.rules import CleanRules

COMPLETENESS_COLUMNS = (
    "invoice_no",
    "stock_code",
    "description",
    "quantity",
    "invoice_date",
    "unit_price",
    "customer_id",
    "country",
)
VALIDITY_COLUMNS = (
    "country",
    "stock_code",
    "invoice_no",
    "description",
    "quantity",
    "invoice_date",
    "unit_price",
)
CONSISTENCY_RULES = ("sales_price", "return_price")


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def all_zero(flags: list[Column]) -> Column:
    return flag(reduce(lambda a, b: a & b, [f == 0 for f in flags]))


def _blank(name: str) -> Column:
    return F.col(name).isNull() | (F.trim(name) == "")


def completeness() -> dict[str, Column]:
    blank = {"invoice_no", "stock_code", "country"}
    optional = {"customer_id"}
    out = {}
    for name in COMPLETENESS_COLUMNS:
        if name in optional:
            out[name] = F.lit(0)
        elif name in blank:
            out[name] = flag(_blank(name))
        else:
            out[name] = flag(F.col(name).isNull())
    return out


def country_invalid(shape: Column, listed: Column, rules: CleanRules) -> Column:
    """1 for a malformed or unlisted country; an unknown country is not invalid.

    The pattern is tested on ``shape`` and membership on ``listed``: staging
    passes the trimmed value twice, the quality rules pass the raw one second.
    """
    return flag(~shape.rlike(R.COUNTRY_PATTERN) | ~listed.isin(*rules.countries))


def more_than_two_decimals(price: Column) -> Column:
    """Whether a price in [0, 1e5), read at 15 significant digits, needs a third decimal.

    Nearly every price takes the first branch: a double that is the nearest one
    to k/100 survives the round trip exactly. Only the rest is formatted.
    """
    digits = F.format_string("%.15g", price).try_cast("decimal(38,18)")
    return (
        F.when(F.rint(price * 100) / 100 == price, F.lit(False))
        .when(F.abs(price) < 0.005, F.lit(True))
        .otherwise(F.round(digits, 2) != digits)
    )


def validity(rules: CleanRules) -> dict[str, Column]:
    text = F.trim("description")
    quantity, price = F.col("quantity"), F.col("unit_price")
    price_range = (price < 0) | (price > rules.max_unit_price)
    return {
        "country": country_invalid(F.trim("country"), F.col("country"), rules),
        "stock_code": flag(
            F.col("stock_code").isNull() | ~F.trim("stock_code").rlike(R.STOCK_CODE_PATTERN)
        ),
        "invoice_no": flag(
            F.col("invoice_no").isNull() | ~F.trim("invoice_no").rlike(R.INVOICE_NO_PATTERN)
        ),
        "description": flag(
            F.col("description").isNull()
            | text.rlike(R.ONLY_SYMBOLS_PATTERN)
            | text.rlike(R.REPEATED_CHARACTER_PATTERN)
        ),
        "quantity": flag(quantity.isNull() | (quantity == 0) | (quantity > rules.max_quantity)),
        "invoice_date": flag(
            F.col("invoice_date").isNull() | (F.col("invoice_date") > rules.now())
        ),
        "unit_price": (
            F.when(price.isNull() | price_range, F.lit(1))
            .when(more_than_two_decimals(price), F.lit(1))
            .otherwise(F.lit(0))
        ),
    }


def consistency() -> dict[str, Column]:
    """Sales and returns must both carry a positive price."""
    unpriced = F.col("unit_price").isNull() | (F.col("unit_price") <= 0)
    return {
        "sales_price": flag((F.col("quantity") > 0) & unpriced),
        "return_price": flag((F.col("quantity") < 0) & unpriced),
    }
