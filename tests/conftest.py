from __future__ import annotations

import sys
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tillgrain.rules import RAW_SCHEMA, CleanRules  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def star(spark):
    """All tables over the smallest star-schema folder."""
    from tillgrain.plans.catalog import lakehouse

    return lakehouse(spark, SMALL)


@pytest.fixture(scope="session")
def filtered(spark, star):
    from tillgrain.sources.tables import materialise

    return materialise(spark, star.txn_filtered, "test_filtered")


RULES = CleanRules(as_of="2026-01-01 00:00:00")

DEFAULT_LINE = {
    "stock_code": "22140",
    "description": "MUG",
    "quantity": 1.0,
    "invoice_date": datetime(2010, 12, 1, 8, 26),
    "unit_price": 1.25,
    "customer_id": "1.0",
    "country": "United Kingdom",
}


def lines(spark, rows: list[dict]):
    """Raw table from partial rows; a row without invoice number gets its own."""
    full = [
        {"invoice_no": f"{600000 + i:06d}", **DEFAULT_LINE, **row} for i, row in enumerate(rows)
    ]
    names = [f.split()[0] for f in RAW_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in full], RAW_SCHEMA)
