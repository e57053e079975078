"""Business rules and the fixed values the results depend on."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values. Results match the agreed definitions only with exactly these.
# ---------------------------------------------------------------------------

RAW_COLUMNS = (
    "invoice_no",
    "stock_code",
    "description",
    "quantity",
    "invoice_date",
    "unit_price",
    "customer_id",
    "country",
)

RAW_SCHEMA = (
    "invoice_no STRING, stock_code STRING, description STRING, quantity DOUBLE,"
    " invoice_date TIMESTAMP_NTZ, unit_price DOUBLE, customer_id STRING, country STRING"
)

COUNTRIES = (
    "United Kingdom", "France", "EIRE", "Germany", "Netherlands", "Spain",
    "Belgium", "Switzerland", "Portugal", "Australia", "Norway", "Italy",
    "Channel Islands", "Finland", "Cyprus", "Sweden", "Austria", "Denmark",
    "Japan", "Poland", "USA", "Singapore", "Iceland", "Canada", "Greece",
    "Israel", "Lithuania", "Malta", "RSA", "European Community",
    "United Arab Emirates", "Saudi Arabia", "Czech Republic", "Lebanon",
    "Brazil", "Bahrain",
)

# Java regex: ``\z`` is the only end-of-text anchor that rejects a final newline.
COUNTRY_PATTERN = r"^[A-Za-z ]+\z"
STOCK_CODE_PATTERN = r"^[A-Za-z0-9 ]+\z"
INVOICE_NO_PATTERN = r"^C?[0-9]{6}\z"
ONLY_SYMBOLS_PATTERN = r"^[^a-zA-Z0-9 ,.\-()/]+\z"
REPEATED_CHARACTER_PATTERN = r"(?isu)(.)\1{4,}"

# Text that the CSV reader of the source system treats as a missing value.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Value of the dq_model column of each metric table.
DQ_MODEL = {
    "completeness": "dq1_completeness",
    "validity": "dq1_validity",
    "uniqueness": "dq1_uniqueness",
    "consistency": "dq1_consistency",
}

SALE_RULE_NAME = "quantity>0 → price>0"
RETURN_RULE_NAME = "quantity<0 → price>0 (returns)"
COMPOSITE_KEY_NAME = "invoice_no + stock_code"

GRADES = ((99, "EXCELLENT"), (95, "GOOD"), (90, "ACCEPTABLE"), (80, "POOR"))
LOWEST_GRADE = "UNACCEPTABLE"
DROP_STRATEGIES = (
    (95, "SAFE TO DROP INVALID ROWS"),
    (85, "REVIEW BEFORE DROPPING"),
    (70, "SEGMENT - Keep clean subset only"),
)
LAST_DROP_STRATEGY = "DO NOT DROP - Data loss too high"

# ---------------------------------------------------------------------------

ROW_KEY = ("invoice_no", "stock_code")
GRAIN_KEY = ("customer_id", "snapshot_date")


@dataclass(frozen=True)
class CleanRules:
    """Thresholds of the pipeline; all become literals in the query plan.

    ``as_of`` is the moment "now" stands for (``yyyy-MM-dd HH:mm:ss``); left
    empty, it is the start of the query. ``first_month`` (inclusive) and
    ``end_month`` (exclusive) bound the month dimension.
    """

    countries: tuple[str, ...] = COUNTRIES
    max_quantity: float = 10000.0
    max_unit_price: float = 99999.99
    pass_rate: str = "0.99"
    warn_rate: str = "0.95"
    as_of: str | None = None
    first_month: str = "2009-12-01"
    end_month: str = "2012-01-01"

    def now(self) -> Column:
        if self.as_of is None:
            return F.localtimestamp()
        return F.lit(self.as_of).cast("timestamp_ntz")

    def dim_low(self) -> Column:
        return F.lit(self.first_month).cast("date")

    def dim_high(self) -> Column:
        """Last month inside the dimension."""
        return F.add_months(F.lit(self.end_month).cast("date"), -1)
