"""Delimited records with line ends in quoted fields, read by many tasks.

Files are read line by line, so they stay splittable. What a line does to the quotes is a function of two states:
whether a quoted field is open after it, if none was open before it, and if one was. Such functions are
composed along the lines of a file split, then along the splits of a file (one row a split), which tells for each
line whether it starts a record. Lines that are whole records are parsed where they are; only the lines of
broken records are shuffled once more and put together again.

A quote opens a field only at the field's start and is written twice inside it. In a file whose first line ends in
carriage return and line feed, line ends in fields become line feeds. A blank line outside quotes is no
record. A field that is still open at the end of its file is an error, as its record would be the rest of the file.
Files where a carriage return alone ends a line aren't read here (``None``).
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import StoredTable, stored_table


class OpenQuote(Exception):
    """A quoted field is never closed."""


def open_after(line: Column, separator: str) -> Column:
    """Whether a quoted field is open after ``line``, none being open before it."""
    start = f"(^|{re.escape(separator)})"
    whole = start + r'"[^"]*+(?:""[^"]*+)*+"(?!")'
    return F.regexp_like(F.regexp_replace(line, whole, "$1-"), F.lit(start + '"'))


def _lines(spark: SparkSession, paths: Sequence[str], encoding: str, separator: str) -> DataFrame:
    """(path, start, at, line, out, inside): every line with the state after it for either state before it."""
    read = spark.read.option("lineSep", "\n").text(list(paths))
    line = F.col("value") if encoding.upper() == "UTF-8" else F.decode(F.col("value").cast("binary"), encoding)
    lines = read.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"),
        line.alias("line"),
    )
    text = F.regexp_replace("line", "\r$", "")
    quoted = F.contains("line", F.lit('"'))
    return lines.withColumns(
        {
            "out": quoted & open_after(text, separator),
            "inside": ~quoted | open_after(F.concat(F.lit('"'), text), separator),
        }
    )


def _composed(rows: DataFrame, window: Window, before: bool) -> DataFrame:
    """Add ``state_out`` and ``state_in``: the composition of the functions (out, inside) of the rows in the window.

    A function is constant (a state is set), swaps the states, or keeps them. The state after some rows is the one set
    last, changed by the swaps since; where none is set, the one before all rows, changed by all swaps.
    """
    over = window.rowsBetween(Window.unboundedPreceding, -1 if before else Window.currentRow)
    swap = F.col("out") & ~F.col("inside")
    setting = F.col("out") == F.col("inside")
    counted = rows.withColumn("_swaps", F.sum(swap.cast("long")).over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    last = F.last(F.when(setting, F.struct(F.col("out").alias("to"), F.col("_swaps").alias("n"))), ignorenulls=True).over(over)
    seen = counted.withColumn("_set", last).withColumn("_all", F.coalesce(F.max("_swaps").over(over), F.lit(0)))
    odd = (F.col("_all") - F.coalesce(F.col("_set.n"), F.lit(0))) % 2 == 1
    after = lambda state: F.coalesce(F.col("_set.to"), F.lit(state)) != odd
    return seen.withColumns({"state_out": after(False), "state_in": after(True)}).drop("_swaps", "_set", "_all")


def _placed(lines: DataFrame) -> DataFrame:
    """Lines with the state before them, for either state before their split."""
    # A split's lines are one window: at most spark.sql.files.maxPartitionBytes of text.
    return _composed(lines, Window.partitionBy("path", "start").orderBy("at"), before=True)


def _starts(state: Column) -> Column:
    """Whether a line starts a record, given the state before it."""
    return ~state & ~F.col("line").isin("", "\r")


def split_table(spark: SparkSession, paths: Sequence[str], encoding: str, separator: str) -> StoredTable:
    """One row a file split: the state before it, records that start before it in its file and in all files."""
    lines = _placed(_lines(spark, paths, encoding, separator))
    each = lines.groupBy("path", "start").agg(
        # A split's own function is its last line's function after the state before that line.
        F.max_by(F.when(F.col("state_out"), F.col("inside")).otherwise(F.col("out")), "at").alias("out"),
        F.max_by(F.when(F.col("state_in"), F.col("inside")).otherwise(F.col("out")), "at").alias("inside"),
        F.count_if(_starts(F.col("state_out"))).alias("_starts_out"),
        F.count_if(_starts(F.col("state_in"))).alias("_starts_in"),
        F.bool_or(F.regexp_like("line", F.lit("\r(?!$)"))).alias("bare_return"),
        F.min_by(F.endswith("line", F.lit("\r")), "at").alias("_return_first"),
    )
    in_file = Window.partitionBy("path").orderBy("start")
    known = _composed(each, in_file, before=True).withColumn("state", F.col("state_out"))
    known = known.withColumn("_starts", F.when(F.col("state"), F.col("_starts_in")).otherwise(F.col("_starts_out")))
    earlier = in_file.rowsBetween(Window.unboundedPreceding, -1)
    known = known.withColumn("before", F.coalesce(F.sum("_starts").over(earlier), F.lit(0)))
    known = known.withColumn("after", F.when(F.col("state"), F.col("inside")).otherwise(F.col("out")))
    # One row a file; a file's first record is its header.
    files = known.groupBy("path").agg((F.sum("_starts") - 1).alias("_records"), F.max_by("after", "start").alias("left_open"), F.min_by("_return_first", "start").alias("returns"))
    across = Window.orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    files = files.withColumn("base", F.coalesce(F.sum(F.greatest("_records", F.lit(0))).over(across), F.lit(0)))
    return stored_table(known.join(files, "path").select("path", "start", "state", "before", "base", "left_open", "returns", "bare_return"))


def read_records(spark: SparkSession, paths: Sequence[str], encoding: str, separator: str) -> DataFrame | None:
    """(row_index, record) of all files, headers left out; ``None`` if a carriage return alone stands in a line."""
    splits = split_table(spark, paths, encoding, separator)
    facts = splits.table.agg(F.bool_or("bare_return").alias("bare"), F.min(F.when(F.col("left_open"), F.col("path"))).alias("open")).first()
    if facts.bare:
        splits.delete()
        return None
    if facts.open:
        splits.delete()
        raise OpenQuote(f"{facts.open}: a quoted field is not closed")
    known = splits.table.select("path", "start", "state", "before", "base", "returns")
    lines = _placed(_lines(spark, paths, encoding, separator)).join(known, ["path", "start"])
    lines = lines.withColumn("state", F.when(F.col("state"), F.col("state_in")).otherwise(F.col("state_out")))
    order = Window.partitionBy("path", "start").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # The header is record 1 of its file.
    number = F.col("before") + F.sum(_starts(F.col("state")).cast("long")).over(order)
    shown = F.when(F.col("returns"), F.regexp_replace("line", "\r$", "")).otherwise(F.col("line")).alias("line")
    numbered = lines.select("path", "start", "at", shown, "state", "base", number.alias("number"), F.when(F.col("state"), F.col("inside")).otherwise(F.col("out")).alias("open"))
    numbered = numbered.where((F.col("number") > 1) & (F.col("state") | _starts(F.col("state"))))
    index = (F.col("base") + F.col("number") - 2).alias("row_index")
    ended = lambda text: F.regexp_replace(text, "\r$", "").alias("record")
    whole = numbered.where(~F.col("state") & ~F.col("open")).select(index, ended(F.col("line")))
    parts = numbered.where(F.col("state") | F.col("open")).groupBy(index).agg(F.array_sort(F.collect_list(F.struct("start", "at", "line"))).alias("lines"))
    return whole.unionByName(parts.select("row_index", ended(F.concat_ws("\n", "lines.line"))))


def parse_records(records: DataFrame, names: Sequence[str], separator: str) -> DataFrame:
    """(row_index, record, the named columns) from record texts."""
    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    options = {"sep": separator, "quote": '"', "escape": '"', "multiLine": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "maxCharsPerColumn": "-1"}
    return records.select("row_index", "record", F.from_csv("record", schema, options).alias("c")).select("row_index", "record", "c.*")
