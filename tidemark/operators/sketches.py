"""Column profiles that merge: distinct counts as sketches, stored by day and joined without reading the rows again.

Exact counts (``profile.column_profile``) stay the default. A sketch of ``lg_k`` bits has a relative standard error
of ``1.04 / sqrt(2 ** lg_k)`` after a merge, 0.8 % by default, and takes at most about ``2 ** lg_k`` bytes a column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.profile import all_cells

LG_K = 14


def standard_error(lg_k: int = LG_K) -> float:
    return 1.04 / 2 ** (lg_k / 2)


def sketch_profile(df: DataFrame, by: Sequence[str] = (), lg_k: int = LG_K) -> DataFrame:
    """One row per segment and column: rows, missing cells and a sketch of the values that are written.

    Missing cells are those of ``profile.is_missing`` and aren't in the sketch. An empty table has no row.
    """
    return all_cells(df, by).groupBy(*by, "column_name").agg(
        F.count("*").alias("total_count"),
        F.count_if("gone").alias("missing_count"),
        F.hll_sketch_agg(F.when(~F.col("gone"), F.col("value")), F.lit(lg_k)).alias("sketch"),
    )


def write_sketches(profiles: DataFrame, path: str, by: str) -> None:
    """Store profiles by one segment column. Segments written before stay, those given again are replaced."""
    profiles.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def merge_sketches(profiles: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Profiles of the union of segments, as one row per ``by`` and column; merges may be merged again.

    Profiles of different ``lg_k`` merge to the smallest.
    """
    return profiles.groupBy(*by, "column_name").agg(
        F.sum("total_count").alias("total_count"),
        F.sum("missing_count").alias("missing_count"),
        F.hll_union_agg("sketch", F.lit(True)).alias("sketch"),
    )


def estimated_profile(profiles: DataFrame) -> DataFrame:
    """Sketches read out: missing share, estimated distinct values and their ratio to all rows."""
    estimate = F.hll_sketch_estimate("sketch")
    return profiles.select(
        *[c for c in profiles.columns if c != "sketch"],
        F.coalesce(F.bround(F.try_divide("missing_count", "total_count") * 100, 2), F.lit(0.0)).alias("missing_percentage"),
        estimate.alias("unique_estimate"),
        F.coalesce(F.bround(F.try_divide(estimate, F.col("total_count")), 4), F.lit(0.0)).alias("unique_ratio"),
    )
