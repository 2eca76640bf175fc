"""Writers. Nothing here ever writes to an input path."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from tidemark.operators.cleaning import CleaningResult


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


def write_cleaning(result: CleaningResult, folder: str, run_at: Column | None = None, mode: str = "errorifexists") -> CleaningResult:
    """Store the flagged parent once, then cleaned, quarantined and audit tables from the stored copy.

    The returned result reads the stored parent, so later steps never repeat the cleaning.
    """
    spark = result.flagged.sparkSession
    result.flagged.write.mode(mode).parquet(f"{folder}/flagged")
    stored = CleaningResult(spark.read.parquet(f"{folder}/flagged"))
    stored.cleaned.write.mode(mode).parquet(f"{folder}/cleaned")
    stored.quarantined.write.mode(mode).parquet(f"{folder}/quarantined")
    stored.audit(run_at).write.mode(mode).partitionBy("transformation_rule").parquet(f"{folder}/audit")
    return stored
