"""Exact most frequent values without shuffling every value.

Three narrow reads in place of one wide shuffle. A sketch names likely values per group. Then one aggregation counts
these exactly and folds all other values into hash buckets; both are a bounded number of rows a task. The count of the
last likely value is a proven lower bound: a value that reaches it lies in a bucket that reaches it. Only the values of
such buckets are counted and shuffled one by one. A poor sketch costs time, never a row of the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.profile import written_cells
from tidemark.session import stored_table

#: Values a sketch follows in each group.
TRACKED = 4_096
#: Buckets of all groups together: the most rows that are broadcast.
ALL_BUCKETS = 1 << 20
#: With more groups than this every value is counted and shuffled.
MOST_GROUPS = 4_096


def _counts(cells: DataFrame) -> DataFrame:
    return cells.groupBy("_group", "_value").agg(F.count("*").alias("n"))


def _slot(buckets: int) -> Column:
    return F.pmod(F.xxhash64("_value"), F.lit(buckets)).cast("int")


def candidate_counts(cells: DataFrame, limit: int, buckets: int) -> DataFrame:
    """(_group, _value, n): exact counts of every value that may be among the ``limit`` most frequent of its group.

    ``cells`` has ``_group`` and ``_value``, neither NULL.
    """
    sketch = F.expr(f"approx_top_k(_value, {limit}, {max(TRACKED, limit)})")
    likely = stored_table(cells.groupBy("_group").agg(sketch.alias("top")).select("_group", "top.item"))
    groups = likely.table.count()
    if groups > MOST_GROUPS:
        return _counts(cells)
    buckets = max(1, min(buckets, ALL_BUCKETS // max(groups, 1)))
    named = likely.table.select("_group", F.explode("item").alias("_value"))

    marked = cells.join(F.broadcast(named.withColumn("_named", F.lit(True))), ["_group", "_value"], "left")
    folded = marked.select(
        "_group",
        F.when(F.col("_named"), F.col("_value")).alias("_value"),
        F.when(F.col("_named").isNull(), _slot(buckets)).alias("_slot"),
    )
    folded = stored_table(folded.groupBy("_group", "_value", "_slot").agg(F.count("*").alias("n"))).table
    counted = folded.where(F.col("_slot").isNull()).select("_group", "_value", "n")
    place = Window.partitionBy("_group").orderBy(F.desc("n"))
    least = counted.withColumn("_place", F.row_number().over(place)).where(F.col("_place") == limit).select("_group", F.col("n").alias("_least"))
    heavy = folded.where(F.col("_slot").isNotNull()).join(F.broadcast(least), "_group", "left").where(F.col("n") >= F.coalesce("_least", F.lit(0)))

    unsure = cells.withColumn("_slot", _slot(buckets)).join(F.broadcast(heavy.select("_group", "_slot")), ["_group", "_slot"], "left_semi")
    return counted.unionByName(_counts(unsure.join(F.broadcast(named), ["_group", "_value"], "left_anti")))


def frequent_values(rows: DataFrame, value: str, by: Sequence[str] = (), limit: int = 5, buckets: int = 4_096) -> DataFrame:
    """The ``limit`` most frequent values of each group with their counts, ties by value (a top-k report).

    NULL values take no part; NULL in ``by`` is a group like any other. ``rows`` is read three times, so store it
    first if it is dear to compute. Result: ``by``, ``value``, ``n``, ``position``.
    """
    group = F.struct(*by) if by else F.struct(F.lit(0).alias("_all"))
    cells = rows.where(F.col(value).isNotNull()).select(group.alias("_group"), F.col(value).alias("_value"))
    place = Window.partitionBy("_group").orderBy(F.desc("n"), "_value")
    top = candidate_counts(cells, limit, buckets).withColumn("position", F.row_number().over(place)).where(F.col("position") <= limit)
    return top.select(*[F.col("_group")[c].alias(c) for c in by], F.col("_value").alias("value"), "n", "position")


def frequent_cells(df: DataFrame, limit: int = 5) -> DataFrame:
    """As ``profile.top_values``, for tables whose columns hold many different values."""
    return frequent_values(written_cells(df), "value", ["column_name"], limit)
