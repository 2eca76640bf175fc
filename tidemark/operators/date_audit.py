"""Temporal consistency checks: one projection for the flags, one aggregate for the summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import vocab
from tidemark.functions.dates import duration_days, parse_date
from tidemark.functions.text import present, stripped
from tidemark.operators.ranks import ranked_values, segment_stats


def reference_point(reference_date: str) -> Column:
    return F.lit(reference_date).cast("date").cast("timestamp_ntz")


def date_flags(raw: dict[str, Column], parsed: dict[str, Column], duration: Column, reference_date: str) -> Column:
    """Array of defect flags of one record, in a fixed order.

    ``raw`` and ``parsed`` are keyed ``intake``, ``closure`` and ``triage``; ``raw`` values are stripped.
    """
    intake, closure, triage = parsed["intake"], parsed["closure"], parsed["triage"]
    ordered = triage.isNotNull() & intake.isNotNull()
    written = {kind: raw[kind] != "" for kind in raw}
    early = (written["intake"] & intake.isNull(), raw["intake"] == "", intake > reference_point(reference_date))
    found = [
        # A record has at most one of the first three.
        (early[0], "INVALID_INTAKE_FORMAT"),
        (early[1], "MISSING_INTAKE_DATE"),
        (~F.coalesce(early[0] | early[1], F.lit(False)) & early[2], "FUTURE_INTAKE_DATE"),
        (written["closure"] & closure.isNull(), "INVALID_CLOSURE_FORMAT"),
        (duration < 0, "NEGATIVE_DURATION"),
        (written["triage"] & triage.isNull(), "INVALID_TRIAGE_FORMAT"),
        (ordered & (triage < intake), "TRIAGE_BEFORE_INTAKE"),
        (ordered & (triage > closure), "TRIAGE_AFTER_CLOSURE"),
    ]
    return present([(applies, F.lit(flag)) for applies, flag in found], "string")


def audit_dates(
    df: DataFrame,
    intake: str = "intake_date",
    closure: str = "closure_date",
    triage: str = "triage_date",
    reference_date: str = vocab.REFERENCE_DATE,
) -> DataFrame:
    """Per row: stripped raw dates, parsed dates, duration, flags and validity."""
    names = {"intake": intake, "closure": closure, "triage": triage}
    source = {k: F.col(v) if v in df.columns else F.lit("") for k, v in names.items()}
    read = df.select(
        "row_index",
        *[stripped(c).alias(f"raw_{k}") for k, c in source.items()],
        *[parse_date(c).alias(f"parsed_{k}") for k, c in source.items()],
    ).withColumn("duration_days", duration_days("parsed_intake", "parsed_closure"))
    flags = date_flags(
        {k: F.col(f"raw_{k}") for k in names},
        {k: F.col(f"parsed_{k}") for k in names},
        F.col("duration_days"),
        reference_date,
    )
    return read.withColumn("error_flags", flags).withColumn("is_valid", F.size("error_flags") == 0)


def date_audit_summary(audited: DataFrame) -> DataFrame:
    """One row of counters plus the mean and median duration of the valid rows."""

    def has(flag: str) -> Column:
        return F.array_contains("error_flags", flag)

    counters = audited.agg(
        F.count("*").alias("total_records"),
        F.count_if("is_valid").alias("valid_date_records"),
        F.count_if(has("INVALID_INTAKE_FORMAT")).alias("unparseable_intake_count"),
        F.count_if(has("INVALID_CLOSURE_FORMAT")).alias("unparseable_closure_count"),
        F.count_if(has("FUTURE_INTAKE_DATE")).alias("future_date_count"),
        F.count_if(has("NEGATIVE_DURATION")).alias("negative_duration_count"),
        F.count_if(has("TRIAGE_BEFORE_INTAKE") | has("TRIAGE_AFTER_CLOSURE")).alias("triage_order_violation_count"),
        F.count_if(
            F.col("parsed_intake").isNotNull() & F.col("parsed_closure").isNull() & ~has("INVALID_CLOSURE_FORMAT")
        ).alias("open_cases_count"),
    )
    usable = F.when(F.col("is_valid") & (F.col("duration_days") >= 0), F.col("duration_days"))
    spread = segment_stats(ranked_values(audited, usable, width=365.0))
    middle = spread.select(F.struct(F.bround("mean", 2).alias("mean"), F.bround("median", 2).alias("median"))).scalar()
    return counters.withColumn("_middle", middle).select(
        *counters.columns,
        F.col("_middle.mean").alias("mean_duration_days"),
        F.col("_middle.median").alias("median_duration_days"),
    )
