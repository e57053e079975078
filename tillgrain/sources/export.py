"""Scorecard and row-flag exports."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillgrain.operators.scorecard import export_rows


def export_scorecard(card: DataFrame, path: str) -> None:
    """Write the 24-row scorecard as one CSV file with a header."""
    export_rows(card).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def export_row_flags(numbered: DataFrame, path: str) -> None:
    """Write numbered row flags as CSV files that are sorted, each and in the order of names.

    The sort is a range shuffle, so files are written in parallel; read one after another
    they give the rows by ``row_id``.
    """
    # Blanks around a value are part of what the flags are about.
    keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "escape": '"'}
    ordered = numbered.sort("row_id").drop("row_id")
    ordered.write.mode("overwrite").options(header=True, **keep).csv(path)
