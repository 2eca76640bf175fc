"""The cell-level audit trail."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import collapsed

AUDIT_COLUMNS = [
    "row_index",
    "case_id",
    "column_name",
    "old_value",
    "new_value",
    "transformation_rule",
    "reason",
    "timestamp",
]
MERGE_STAGE = 800
#: SQL type of an :func:`entry`.
ENTRY = "struct<stage: int, column_name: string, old_value: string, new_value: string, transformation_rule: string, reason: string>"


def entry(stage: int, column: str, old: Column, new: Column, rule: str, reason: Column) -> Column:
    """One audit entry; ``stage`` orders entries the way the stages run."""
    return F.struct(
        F.lit(stage).alias("stage"),
        F.lit(column).alias("column_name"),
        old.alias("old_value"),
        new.alias("new_value"),
        F.lit(rule).alias("transformation_rule"),
        reason.alias("reason"),
    )


def audit_log(flagged: DataFrame, run_at: Column | None = None) -> DataFrame:
    """Unfold a flagged table's entries into the audit table. ``stage`` and ``step`` give its order."""
    stamp = F.current_timestamp() if run_at is None else run_at
    merge = F.array(
        entry(MERGE_STAGE, "RECORD", F.lit("ACTIVE"), F.lit("MERGED_DUPLICATE"), "DEDUPLICATION_MERGE",
              F.lit("Deduplicated redundant case matching primary canonical submission"))
    )
    entries = F.when(F.col("merged_into").isNotNull(), F.concat("audit_entries", merge)).otherwise(F.col("audit_entries"))
    unfolded = flagged.select("row_index", "raw_case_id", F.posexplode(entries).alias("step", "e"))
    # Row-level decisions were taken on the collapsed id, cell rules and merges on the raw one.
    case_id = F.when(F.col("e.stage") == 700, collapsed("raw_case_id")).otherwise(F.col("raw_case_id"))
    return unfolded.select(
        "row_index",
        case_id.alias("case_id"),
        "e.column_name",
        "e.old_value",
        "e.new_value",
        "e.transformation_rule",
        "e.reason",
        stamp.cast("string").alias("timestamp"),
        F.col("e.stage").alias("stage"),
        "step",
    )


def in_run_order(audit: DataFrame) -> DataFrame:
    """The audit table sorted stage by stage, without its ordering columns."""
    return audit.orderBy("stage", "row_index", "step").select(*AUDIT_COLUMNS)


def audit_summary(audit: DataFrame) -> DataFrame:
    """Total, distinct rows, and counts per rule and per column, as (scope, name, entries, rows)."""
    grouped = audit.groupingSets(
        [[], ["transformation_rule"], ["column_name"]], "transformation_rule", "column_name"
    ).agg(F.count("*").alias("entries"), F.count_distinct("row_index").alias("rows"), F.grouping_id().alias("g"))
    return grouped.select(
        F.when(F.col("g") == 3, "total").when(F.col("g") == 1, "rule").otherwise("column").alias("scope"),
        F.when(F.col("g") == 3, "all").when(F.col("g") == 1, F.col("transformation_rule")).otherwise(F.col("column_name")).alias("name"),
        "entries",
        "rows",
    )
