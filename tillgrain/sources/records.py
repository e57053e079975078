"""CSV records whose quoted fields may hold line breaks, cut in parallel.

A line alone does not tell whether it begins inside a quoted field, so each line is taken as
a function of that state: where it ends when it begins outside, and when it begins inside.
Such functions of two states are constant, the identity or a swap, so that the state before
any line follows from the last constant line and the number of swaps since. That gives the
function of each block of the file; composing the blocks, of which there are few, gives the
state each block begins with. All lines of a file are read, and placed, by as many tasks as
it has blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A field in quotes with what follows its closing quote; a doubled quote is part of the text.
_BODY = r'[^"]*+(?:""[^"]*+)*+"[^,]*'
_COMPLETE = rf'(^|,)"{_BODY}'
_OPEN = r'(^|,)"'


def _ends_inside(text: Column) -> Column:
    """1 if a field opened in the text, which begins outside of quotes, is still open."""
    return F.regexp_replace(text, _COMPLETE, "$1").rlike(_OPEN).cast("int")


def _composed(state: Column, constant: Column, swaps: Column, swaps_then: Column) -> Column:
    """The state after the last constant function, or else ``state``, and the swaps since."""
    return F.pmod(F.coalesce(constant, state) + swaps - F.coalesce(swaps_then, F.lit(0)), F.lit(2))


def _prefixes(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """``outside`` and ``inside`` replaced by the composition of all rows up to this one."""
    upto = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    constant = F.col("outside") == F.col("inside")
    rows = rows.withColumn("_swaps", F.sum((F.col("outside") > F.col("inside")).cast("int")).over(upto))
    rows = rows.withColumns(
        {
            "_value": F.last(F.when(constant, F.col("outside")), True).over(upto),
            "_then": F.last(F.when(constant, F.col("_swaps")), True).over(upto),
        }
    )
    parts = F.col("_value"), F.col("_swaps"), F.col("_then")
    return rows.withColumns(
        {"outside": _composed(F.lit(0), *parts), "inside": _composed(F.lit(1), *parts)}
    ).drop("_swaps", "_value", "_then")


def lines(spark: SparkSession, path: str, encoding: str = "ISO-8859-1") -> DataFrame:
    """(file, block, line, text): ``block`` is where the split that holds the line begins, and
    ``line`` rises within it."""
    return (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
            F.decode(F.col("value").cast("binary"), encoding).alias("text"),
        )
    )


def records(found: DataFrame) -> DataFrame:
    """(file, block, number, text): one row per record; number 1 of block 0 is the header.

    ``block`` is that of the record's first line and ``number`` its place there, from 1. Only
    records of several lines are grouped. A file that ends inside a quoted field raises: its
    records cannot be told apart. Lines of blanks between records are none.
    """
    closed = F.regexp_replace("text", f"^{_BODY}", "")
    still_open = ~F.col("text").rlike(f"^{_BODY}")
    states = found.withColumns(
        {
            "outside": _ends_inside(F.col("text")),
            "inside": F.when(still_open, 1).otherwise(_ends_inside(closed)),
        }
    )
    placed = _prefixes(states, ["file", "block"], "line")
    ordered = Window.partitionBy("file", "block").orderBy("line")
    blank = F.trim(F.regexp_replace("text", r"[\t\r]", "")) == ""
    # The state before each line, and whether a record begins there, for both entry states.
    starts = {}
    for entry, name in enumerate(("outside", "inside")):
        before = F.lag(name, 1, entry).over(ordered)
        starts[f"_starts_{name}"] = ((before == 0) & ~blank).cast("int")
        starts[f"_within_{name}"] = before
    placed = placed.withColumns(starts)
    blocks = placed.groupBy("file", "block").agg(
        F.max_by("outside", "line").alias("outside"),
        F.max_by("inside", "line").alias("inside"),
        F.sum("_starts_outside").alias("_n_outside"),
        F.sum("_starts_inside").alias("_n_inside"),
    )
    # One row per block of a file.
    by_file = Window.partitionBy("file")
    in_order = by_file.orderBy("block")
    composed = _prefixes(blocks, ["file"], "block")
    entered = composed.withColumns(
        {
            "_entry": F.lag("outside", 1, 0).over(in_order),
            "_final": F.last("outside").over(
                in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
            ),
        }
    )
    own = F.when(F.col("_entry") == 0, F.col("_n_outside")).otherwise(F.col("_n_inside"))
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    entered = entered.withColumn("_n", own).select(
        "file",
        "block",
        "_entry",
        "_final",
        F.last(F.when(F.col("_n") > 0, F.struct("block", "_n")), True).over(earlier).alias("_owner"),
    )
    outside = F.col("_entry") == 0
    begins = F.when(outside, F.col("_starts_outside")).otherwise(F.col("_starts_inside"))
    unclosed = F.raise_error(F.concat(F.lit("quote without its other end in "), F.col("file")))
    told = placed.join(entered, ["file", "block"]).select(
        "file",
        "block",
        "line",
        F.when(F.col("_final") == 1, unclosed.cast("string")).otherwise(F.col("text")).alias("text"),
        "_owner",
        begins.alias("_begins"),
        F.when(outside, F.col("_within_outside")).otherwise(F.col("_within_inside")).alias("_before"),
        F.when(outside, F.col("outside")).otherwise(F.col("inside")).alias("_after"),
    )
    upto = ordered.rowsBetween(Window.unboundedPreceding, 0)
    told = told.withColumn("_number", F.sum("_begins").over(upto))
    carried = F.col("_number") == 0
    told = told.where("_begins = 1 or _before = 1").select(
        "file",
        F.when(carried, F.col("_owner.block")).otherwise(F.col("block")).alias("block"),
        F.when(carried, F.col("_owner._n")).otherwise(F.col("_number")).alias("number"),
        F.struct(F.col("block").alias("at"), "line", "text").alias("_line"),
        ((F.col("_begins") == 1) & (F.col("_after") == 0)).alias("_whole"),
    )
    single = told.where("_whole").select("file", "block", "number", F.col("_line.text").alias("text"))
    joined = (
        told.where("not _whole")
        .groupBy("file", "block", "number")
        .agg(F.sort_array(F.collect_list("_line")).alias("_lines"))
        .select("file", "block", "number", F.array_join("_lines.text", "\n").alias("text"))
    )
    every = single.unionByName(joined)
    return every.withColumn("text", F.regexp_replace("text", r"\r\z", ""))
