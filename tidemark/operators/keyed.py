"""Bringing a per-key aggregate back onto the rows, whatever the key's skew.

The aggregate folds a hot key on the map side, so it has one row a key. The join back keeps all rows on its
left side: a small aggregate is broadcast by the planner's own size check, a large one is a shuffled left
join on the key and its ``place``. The place of a NULL key, which matches nothing, comes from the rest of the row, so
NULL keys are dealt to all partitions. Columns that make places are shuffled even if nothing else asks for them, so a caller
with a row number names it (``dealt_by``), and the planner drops all columns that aren't asked for. As the aggregate isn't laid out by place, it is shuffled for the join as well, and
only a join whose both sides come straight from a shuffle has its hot partitions split by adaptive execution
(``spark.sql.adaptive.skewJoin``, on by default); the right side holds a single row for a hot key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _place(df: DataFrame, key: str, dealt_by: Sequence[str]) -> Column:
    """A number that goes with the key; with ``dealt_by``, or the rest of the row, where the key is NULL."""
    rest = [F.col(c) for c, kind in df.dtypes if c != key and "map<" not in kind and (not dealt_by or c in dealt_by)]
    return F.when(F.col(key).isNotNull(), F.xxhash64(key)).otherwise(F.xxhash64(*rest) if rest else F.lit(0).cast("long"))


def _keyed(df: DataFrame, key: str, other: str, dealt_by: Sequence[str]) -> Column:
    return (F.col(key) == F.col(other)) & (_place(df, key, dealt_by) == F.xxhash64(other))


def with_key_stats(df: DataFrame, key: str, stats: dict[str, Column], min_rows: int = 2, dealt_by: Sequence[str] = ()) -> DataFrame:
    """Adds ``key_rows`` and the ``stats`` aggregates of each row's key.

    Rows whose key is NULL, and keys with fewer than ``min_rows`` rows, get NULLs.
    """
    names = ["key_rows", *stats]
    # count(key) leaves the NULL group at zero rows. A filter on the key itself would be pushed down
    # to the scan and evaluate the whole expression behind the key a second time there.
    grouped = df.groupBy(F.col(key).alias("_key")).agg(
        F.count(key).alias("key_rows"), *[c.alias(n) for n, c in stats.items()]
    )
    repeated = grouped.where(F.col("key_rows") >= max(1, min_rows)).select("_key", *[F.col(n).alias(f"_{n}") for n in names])
    joined = df.join(repeated, _keyed(df, key, "_key", dealt_by), "left")
    return joined.select(*[F.col(c) for c in df.columns], *[F.col(f"_{n}").alias(n) for n in names])


def with_key_counts(df: DataFrame, keys: dict[str, str], min_rows: int = 2, dealt_by: Sequence[str] = ()) -> DataFrame:
    """Adds, for each key column, how many rows share the row's key (NULL below ``min_rows``), counted in one pass.

    ``keys`` maps key columns to output columns. Keys of different columns must differ, by a prefix for
    instance, as they are counted in one table, which is aggregated once and joined once per column.
    """
    each = df.select(F.explode(F.array(*[F.col(k) for k in keys])).alias("_key"))
    counts = each.groupBy("_key").agg(F.count("_key").alias("_rows")).where(F.col("_rows") >= max(1, min_rows))
    for key, name in keys.items():
        own = counts.select(F.col("_key").alias(f"_of_{key}"), F.col("_rows").alias(name))
        df = df.join(own, _keyed(df, key, f"_of_{key}", dealt_by), "left").drop(f"_of_{key}")
    return df
