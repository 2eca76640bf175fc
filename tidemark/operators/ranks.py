"""Exact ranks, medians and quantiles without ever holding one group in one task.

Rows are first reduced to (segment, value, count); everything after works on that table. The running
count over sorted values is split into value buckets of a stated size: a window runs inside each bucket, and the
buckets' totals are accumulated separately.

Buckets only decide where work happens, never the result, as long as they grow with the value. They
are functions of the data alone (no sampling by partition), so a recomputed task after an executor
loss lands every value in the same bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import stored_table

# No bucket holds more distinct values than this: a bucket over it is cut at some ``_EDGES`` of its own values.
ONE_BUCKET_LIMIT = 100_000
_EDGES = 256
# Buckets to cut in one go up to which their edges (2 KB each) are broadcast.
_SENT = 2_000


def join_by(left: DataFrame, right: DataFrame, by: Sequence[str], on: Sequence[str] = (), how: str = "inner") -> DataFrame:
    """Join on segment columns ``by``, where NULL is a segment like any other, and never-NULL columns ``on``."""
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in by or c in on else F.col(c) for c in right.columns])
    same = F.lit(True)
    for name in on:
        same = same & (F.col(name) == F.col(f"_r_{name}"))
    for name in by:
        same = same & F.col(name).eqNullSafe(F.col(f"_r_{name}"))
    return left.join(renamed, same, how).drop(*[f"_r_{c}" for c in (*by, *on)])


def count_values(df: DataFrame, value: Column | str, by: Sequence[str] = ()) -> DataFrame:
    """(by…, value, n) over the non-NULL values: the only step that reads the rows."""
    column = F.col(value) if isinstance(value, str) else value
    return (
        df.select(*by, column.cast("double").alias("value"))
        .groupBy(*by, "value")
        .agg(F.count("value").alias("n"))
        .where(F.col("n") > 0)  # drops the NULL group; a filter on the value would evaluate it twice
    )


def _estimated_bytes(df: DataFrame) -> int:
    """The planner's estimate. It only decides whether buckets are looked at, which no result depends on."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _edges_below(edges: Column, value: Column) -> Column:
    """How many of the sorted edges are no larger than the value, by bisection."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(_EDGES.bit_length() + 2))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(edges, at + step - 1) <= value, at + step).otherwise(at))


def _bucketed(counts: DataFrame, by: list[str], width: float | None) -> DataFrame:
    """Adds ``bucket``, which grows with the value and holds at most ``ONE_BUCKET_LIMIT`` values, unless ``width`` is given
    or the planner takes the whole table for smaller than that.

    A bucket is the path of its places, level by level: only buckets over the limit are cut again, so the depth
    follows the data, and a level costs one pass over the stored (segment, value) table and one number on the driver.
    """
    if width is not None:
        return counts.withColumn("bucket", F.floor(F.col("value") / F.lit(width)))
    if _estimated_bytes(counts) <= 16 * ONE_BUCKET_LIMIT:  # a value and its count: nothing to cut, so nothing is computed ahead
        return counts.withColumn("bucket", F.lit(0))
    placed, level = stored_table(counts.withColumn("bucket", F.array().cast("array<int>"))), 0
    while True:
        full = placed.table.groupBy(*by, "bucket").agg(F.count("*").alias("d")).where(F.col("d") > ONE_BUCKET_LIMIT)
        wide = full.count()
        if not wide:
            return placed.table
        # Edges are the values whose hash falls in one residue class: a sample fixed by the data, some ``_EDGES`` a bucket.
        chosen = F.pmod(F.xxhash64("value", F.lit(level)), F.ceil(F.col("d") / _EDGES)) == 0
        among = F.broadcast(full) if wide <= _SENT else full
        edges = join_by(placed.table, among, by, ["bucket"]).where(chosen).groupBy(*by, "bucket").agg(F.array_sort(F.collect_list("value")).alias("edges"))
        cut = join_by(placed.table, F.broadcast(edges) if wide <= _SENT else edges, by, ["bucket"], "left")
        path = F.concat("bucket", F.array(_edges_below(F.col("edges"), F.col("value"))))
        after = stored_table(cut.withColumn("bucket", F.when(F.col("edges").isNull(), F.col("bucket")).otherwise(path)).drop("edges"))
        placed.delete()
        placed, level = after, level + 1


def rank_counts(counts: DataFrame, by: Sequence[str] = (), width: float | None = None) -> DataFrame:
    """Adds ``before`` (rows with a smaller value), ``total``, ``mean`` and ``mid_rank`` per segment.

    ``width`` fixes the bucket width in value units and fits values of limited resolution: durations
    kept to two decimals have at most 36,500 distinct values in a 365-day bucket, whatever the table
    size. Leave it out for arbitrary doubles.
    """
    by = list(by)
    placed = _bucketed(counts, by, width)
    totals = placed.groupBy(*by, "bucket").agg(
        F.sum("n").alias("bucket_n"), F.sum(F.col("n") * F.col("value")).alias("bucket_sum")
    )
    upto = Window.partitionBy(*by).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    offsets = totals.select(
        *by,
        "bucket",
        F.coalesce(F.sum("bucket_n").over(upto), F.lit(0)).alias("offset"),
        F.sum("bucket_n").over(whole).alias("total"),
        (F.sum("bucket_sum").over(whole) / F.sum("bucket_n").over(whole)).alias("mean"),
    )
    inside = Window.partitionBy(*by, "bucket").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    running = placed.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    left, right = running.alias("l"), offsets.alias("r")
    same = F.col("l.bucket") == F.col("r.bucket")
    for name in by:
        same = same & F.col(f"l.{name}").eqNullSafe(F.col(f"r.{name}"))
    before = F.col("r.offset") + F.col("l.inside")
    return left.join(right, same).select(
        *[F.col(f"l.{name}").alias(name) for name in by],
        F.col("l.value").alias("value"),
        F.col("l.n").alias("n"),
        before.alias("before"),
        F.col("r.total").alias("total"),
        F.col("r.mean").alias("mean"),
        (before + (F.col("l.n") + F.lit(1)) / F.lit(2.0)).alias("mid_rank"),
    )


def ranked_values(df: DataFrame, value: Column | str, by: Sequence[str] = (), width: float | None = None) -> DataFrame:
    """:func:`count_values` followed by :func:`rank_counts`."""
    return rank_counts(count_values(df, value, by), by, width)


def quantile(p: float) -> Column:
    """Aggregate over ranked values: the exact quantile, linear between neighbours."""
    place = (F.col("total") - F.lit(1)) * F.lit(p)
    low, high = F.floor(place), F.ceil(place)

    def at(i: Column) -> Column:
        return F.max(F.when((F.col("before") <= i) & (i < F.col("before") + F.col("n")), F.col("value")))

    return at(low) + (at(high) - at(low)) * F.max(place - low)


def sample_std() -> Column:
    """Aggregate over ranked values: standard deviation with n − 1, NULL for a single row."""
    spread = F.sum(F.col("n") * F.pow(F.col("value") - F.col("mean"), F.lit(2)))
    return F.when(F.max("total") > 1, F.sqrt(spread / (F.max("total") - F.lit(1))))


def segment_stats(ranked: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """count, mean, median and sample standard deviation per segment."""
    return ranked.groupBy(*by).agg(
        F.sum("n").alias("count"),
        F.max("mean").alias("mean"),
        quantile(0.5).alias("median"),
        sample_std().alias("std"),
    )
