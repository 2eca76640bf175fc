"""A dense row number that follows file order, whatever the partitioning.

A row's number is its place inside its file split plus the rows of all splits before it. Splits are
listed by file and offset; only that list, one line per split, is accumulated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_row_index(df: DataFrame) -> DataFrame:
    """Add ``row_index`` (0, 1, 2, …) to a table read straight from files."""
    tagged = df.select(
        "*",
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_at"),
    )
    splits = tagged.groupBy("_path", "_start").agg(F.min("_at").alias("_low"), F.count("*").alias("_rows"))
    in_file = Window.partitionBy("_path").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    files = splits.groupBy("_path").agg(F.sum("_rows").alias("_file_rows"))
    # One line per file.
    across = Window.orderBy("_path").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("_path", F.coalesce(F.sum("_file_rows").over(across), F.lit(0)).alias("_file_base"))
    bases = (
        splits.withColumn("_inside", F.coalesce(F.sum("_rows").over(in_file), F.lit(0)))
        .join(starts, "_path")
        .select("_path", "_start", (F.col("_inside") + F.col("_file_base") - F.col("_low")).alias("_base"))
    )
    numbered = tagged.join(bases, ["_path", "_start"])
    return numbered.select((F.col("_at") + F.col("_base")).alias("row_index"), *df.columns)

