"""Table checks: each counts the rows that break one expectation.

A check reads one or two named tables and yields (check_name, failing_rows,
severity); zero failing rows is a pass. ``violations`` gives the rows
themselves. All row-level checks of a table share one scan, and so do its value lists.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Tables = Mapping[str, DataFrame]

ROW_KINDS = ("not_null", "expression", "at_least_one")


@dataclass(frozen=True)
class Check:
    name: str
    kind: str
    table: str
    columns: tuple[str, ...] = ()
    expression: str = ""
    values: tuple = ()
    other_table: str = ""
    other_columns: tuple[str, ...] = ()
    severity: str = "error"


# -- constructors ------------------------------------------------------------


def not_null(table: str, column: str, **more) -> Check:
    return Check(f"{table}.{column}.not_null", "not_null", table, (column,), **more)


def unique(table: str, column: str, **more) -> Check:
    """Known values occur once."""
    return Check(f"{table}.{column}.unique", "unique", table, (column,), **more)


def accepted_values(table: str, column: str, values: Iterable, **more) -> Check:
    """Known values are listed; failing are the distinct unlisted ones."""
    name = f"{table}.{column}.accepted_values"
    return Check(name, "accepted_values", table, (column,), values=tuple(values), **more)


def relationships(table: str, column: str, parent: str, parent_column: str, **more) -> Check:
    """Known values exist in the parent; failing are the rows that refer to nothing."""
    return Check(
        f"{table}.{column}.relationships", "relationships", table, (column,),
        other_table=parent, other_columns=(parent_column,), **more,
    )


def expression_is_true(table: str, name: str, expression: str, **more) -> Check:
    """The expression is not false; unknown passes."""
    return Check(f"{table}.{name}", "expression", table, expression=expression, **more)


def unique_combination(table: str, columns: Iterable[str], **more) -> Check:
    """Column combinations occur once, unknown parts being equal to each other."""
    columns = tuple(columns)
    name = f"{table}.{'+'.join(columns)}.unique"
    return Check(name, "unique_combination", table, columns, **more)


def at_least_one(table: str, column: str, **more) -> Check:
    """The column is not empty throughout."""
    return Check(f"{table}.{column}.at_least_one", "at_least_one", table, (column,), **more)


def equal_row_count(table: str, other: str, **more) -> Check:
    """Failing is the difference of the two row counts."""
    return Check(
        f"{table}.row_count_equals.{other}", "equal_row_count", table,
        other_table=other, **more,
    )


def row_count_is(table: str, rows: int, **more) -> Check:
    """Failing is the distance from the expected number of rows."""
    return Check(f"{table}.row_count_is_{rows}", "row_count", table, values=(rows,), **more)


# -- failing rows ------------------------------------------------------------


def _broken(check: Check) -> Column:
    """Condition that holds on the rows failing a row-level check."""
    if check.kind == "not_null":
        return F.col(check.columns[0]).isNull()
    if check.kind == "expression":
        return ~F.expr(check.expression)
    if check.kind == "accepted_values":
        return ~F.col(check.columns[0]).isin(*check.values)
    raise ValueError(f"{check.kind} is not decided row by row")


def _repeated(df: DataFrame, columns: tuple[str, ...], known_only: bool) -> DataFrame:
    if known_only:
        df = df.where(F.col(columns[0]).isNotNull())
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records"))
    return counted.where(F.col("n_records") > 1)


def _orphans(check: Check, tables: Tables) -> DataFrame:
    """Values without a parent and how many rows hold each.

    Both sides shrink to distinct values before the join, so a value held by
    a large part of the rows joins once.
    """
    column, parent_column = check.columns[0], check.other_columns[0]
    children = (
        tables[check.table]
        .where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )
    parents = (
        tables[check.other_table].select(F.col(parent_column).alias("value")).distinct()
    )
    return children.join(parents, "value", "left_anti")


def violations(check: Check, tables: Tables) -> DataFrame:
    """The rows, keys or values that break the check."""
    df = tables[check.table]
    if check.kind in ("not_null", "expression"):
        return df.where(_broken(check))
    if check.kind == "accepted_values":
        column = check.columns[0]
        return df.where(_broken(check)).groupBy(column).agg(
            F.count(F.lit(1)).alias("n_records")
        )
    if check.kind == "unique":
        return _repeated(df, check.columns, known_only=True)
    if check.kind == "unique_combination":
        return _repeated(df, check.columns, known_only=False)
    if check.kind == "relationships":
        return _orphans(check, tables)
    return results([check], tables).where(F.col("failing_rows") > 0)


# -- counts ------------------------------------------------------------------


def _labelled(check: Check, counted: DataFrame) -> DataFrame:
    return counted.select(
        F.lit(check.name).alias("check_name"),
        F.coalesce(F.col("failing_rows"), F.lit(0)).cast("bigint").alias("failing_rows"),
        F.lit(check.severity).alias("severity"),
    )


def _row_level_count(check: Check) -> Column:
    if check.kind == "at_least_one":
        return (F.count(check.columns[0]) == 0).cast("bigint")
    return F.count_if(_broken(check))


def _row_level_results(checks: list[Check], df: DataFrame) -> DataFrame:
    """One aggregate row for all checks, then one output row per check."""
    counted = df.agg(
        *[_row_level_count(c).cast("bigint").alias(f"c{i}") for i, c in enumerate(checks)]
    )
    return _one_row_each(checks, counted)


def _one_row_each(checks: list[Check], counted: DataFrame) -> DataFrame:
    rows = [
        F.struct(
            F.lit(c.name).alias("check_name"),
            F.col(f"c{i}").alias("failing_rows"),
            F.lit(c.severity).alias("severity"),
        )
        for i, c in enumerate(checks)
    ]
    return counted.select(F.inline(F.array(*rows)))


def _accepted_values_results(checks: list[Check], df: DataFrame) -> DataFrame:
    """One scan for the value lists of a table.

    Failing rows are few: they are filtered first, then each failing value becomes a row, typed as
    it is, with the number of its check; these are grouped before they are counted.
    """
    columns = [c.columns[0] for c in checks]
    types = [f.dataType for f in df.select(*columns).schema]

    def unlisted(i: int) -> Column:
        held = [
            (F.col(c) if j == i else F.lit(None).cast(types[j])).alias(f"v{j}")
            for j, c in enumerate(columns)
        ]
        return F.when(_broken(checks[i]), F.struct(F.lit(i).alias("check"), *held))

    failing = df.where(reduce(Column.__or__, [_broken(c) for c in checks]))
    found = F.array_compact(F.array(*[unlisted(i) for i in range(len(checks))]))
    values = failing.select(F.explode(found).alias("value"))
    counted = (
        values.select("value.*")
        .distinct()
        .agg(*[F.count_if(F.col("check") == i).alias(f"c{i}") for i in range(len(checks))])
    )
    return _one_row_each(checks, counted)


def _row_total(df: DataFrame, sign: int) -> DataFrame:
    return df.agg((F.count(F.lit(1)) * sign).alias("rows"))


def _table_level_result(check: Check, tables: Tables) -> DataFrame:
    if check.kind in ("unique", "unique_combination"):
        counted = violations(check, tables).agg(F.count(F.lit(1)).alias("failing_rows"))
    elif check.kind == "relationships":
        counted = _orphans(check, tables).agg(F.sum("n_records").alias("failing_rows"))
    elif check.kind == "equal_row_count":
        both = _row_total(tables[check.table], 1).unionByName(
            _row_total(tables[check.other_table], -1)
        )
        counted = both.agg(F.abs(F.sum("rows")).alias("failing_rows"))
    elif check.kind == "row_count":
        distance = F.abs(F.count(F.lit(1)) - check.values[0])
        counted = tables[check.table].agg(distance.alias("failing_rows"))
    else:
        raise ValueError(f"unknown kind of check: {check.kind}")
    return _labelled(check, counted)


def _scans(checks: list[Check]) -> list[list[Check]]:
    """Checks by scan: those of a table that share one, then the others by themselves."""
    shared = []
    for table in dict.fromkeys(c.table for c in checks):
        own = [c for c in checks if c.table == table]
        shared.append([c for c in own if c.kind in ROW_KINDS])
        shared.append([c for c in own if c.kind == "accepted_values"])
    single = [[c] for c in checks if c.kind not in (*ROW_KINDS, "accepted_values")]
    return [s for s in shared if s] + single


def parts(checks: Iterable[Check]) -> list[list[str]]:
    """The tables that each part of the checks' results reads."""
    return [
        [t for t in (scan[0].table, scan[0].other_table) if t] for scan in _scans(list(checks))
    ]


def _scan_results(scan: list[Check], tables: Tables) -> DataFrame:
    if scan[0].kind in ROW_KINDS:
        return _row_level_results(scan, tables[scan[0].table])
    if scan[0].kind == "accepted_values":
        return _accepted_values_results(scan, tables[scan[0].table])
    return _table_level_result(scan[0], tables)


def results(checks: Iterable[Check], tables: Tables) -> DataFrame:
    """(check_name, failing_rows, severity) for every check."""
    found = [_scan_results(scan, tables) for scan in _scans(list(checks))]
    return reduce(DataFrame.unionByName, found)


def verdicts(outcome: DataFrame) -> DataFrame:
    """Add pass / warn / fail by severity."""
    failed = F.when(F.col("severity") == "warn", F.lit("warn")).otherwise(F.lit("fail"))
    return outcome.withColumn(
        "outcome", F.when(F.col("failing_rows") == 0, F.lit("pass")).otherwise(failed)
    )
