"""Report and figure tables. Each is an aggregate small enough to read, computed from whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.cleaning import CleaningResult
from tidemark.operators.findings import monthly_cohorts, urgent_cases
from tidemark.operators.stats import DURATION_WIDTH, box_stats, group_breakdown


def _with_error_band(stats: DataFrame) -> DataFrame:
    """Mean ± one standard error."""
    error = F.col("std") / F.sqrt("count")
    return stats.withColumn("std_err", error).withColumn("lower", F.col("mean") - error).withColumn("upper", F.col("mean") + error)


def monthly_trend(closed: DataFrame) -> DataFrame:
    """Per month: count, mean, median, error band, month index and the trend of the monthly means."""
    cohorts = _with_error_band(monthly_cohorts(closed))
    # One row per month: this window runs over the aggregate, never over cases.
    indexed = cohorts.withColumn("month_idx", F.row_number().over(Window.orderBy("intake_month")) - 1)
    every = Window.partitionBy()
    slope, intercept = F.regr_slope("mean", "month_idx").over(every), F.regr_intercept("mean", "month_idx").over(every)
    return indexed.withColumn("trend_mean", slope * F.col("month_idx") + intercept).orderBy("month_idx")


def category_spread(closed: DataFrame) -> DataFrame:
    """Categories by median duration, longest first, with mean ± SE."""
    stats = group_breakdown(closed, "duration_days", ["category"], DURATION_WIDTH)
    return _with_error_band(stats).orderBy(F.desc("median"), "category")


def lifecycle_funnel(result: CleaningResult) -> DataFrame:
    """Rows left after each stage and their share of the raw table."""
    s = result.summary
    stages = F.array(
        *[
            F.struct(F.lit(i).alias("step"), F.lit(name).alias("stage"), rows.alias("rows"))
            for i, (name, rows) in enumerate(
                [
                    ("Raw Input", F.col("initial_rows")),
                    ("After Quarantine", F.col("initial_rows") - F.col("quarantined_rows")),
                    ("After Deduplication", F.col("initial_rows") - F.col("quarantined_rows") - F.col("deduplicated_rows")),
                    ("Analytical Records", F.col("final_rows")),
                ]
            )
        ]
    )
    return s.select("initial_rows", F.explode(stages).alias("x")).select(
        "x.step", "x.stage", "x.rows", F.bround(F.try_divide(F.col("x.rows"), F.col("initial_rows")) * 100, 1).alias("pct_of_raw")
    )


def dispositions(result: CleaningResult) -> DataFrame:
    """Rows by outcome: clean, quarantined, merged."""
    counts = result.flagged.groupBy("disposition").agg(F.count("*").alias("rows"))
    total = F.sum("rows").over(Window.partitionBy())  # over the three outcomes
    return counts.withColumn("pct", F.bround(F.col("rows") / total * 100, 1))


def triage_boxes(closed: DataFrame) -> DataFrame:
    return box_stats(urgent_cases(closed), "duration_days", ["triaged"], DURATION_WIDTH)


def category_triage_means(closed: DataFrame) -> DataFrame:
    """Mean urgent duration per category, one column per triage state, 0 where there is none."""
    rows = urgent_cases(closed)
    return rows.groupBy("category").agg(
        F.coalesce(F.avg(F.when(~F.col("triaged"), F.col("duration_days"))), F.lit(0.0)).alias("not_triaged"),
        F.coalesce(F.avg(F.when(F.col("triaged"), F.col("duration_days"))), F.lit(0.0)).alias("triaged"),
    )


def dataset_overview(result: CleaningResult, columns: int) -> DataFrame:
    """One row: raw, quarantined, merged and final rows, retention and attrition, audit entries."""
    raw, final = F.col("initial_rows"), F.col("final_rows")
    return result.summary.select(
        raw.alias("raw_records"),
        F.lit(columns).alias("columns"),
        F.col("quarantined_rows").alias("quarantined"),
        F.col("deduplicated_rows").alias("deduplicated"),
        final.alias("final_records"),
        F.bround(final / F.greatest(F.lit(1), raw) * 100, 1).alias("retention_pct"),
        F.bround((raw - final) / F.greatest(F.lit(1), raw) * 100, 1).alias("attrition_pct"),
        F.col("modifications").alias("audit_entries"),
    )


def censoring_by_month(cleaned: DataFrame) -> DataFrame:
    """Share of each intake cohort that is still open, hence right-censored."""
    months = cleaned.where(F.col("intake_date").isNotNull()).groupBy(F.substring("intake_date", 1, 7).alias("intake_month"))
    return months.agg(
        F.count("*").alias("cases"), F.count_if(F.col("closure_date").isNull()).alias("open_cases")
    ).withColumn("open_share", F.col("open_cases") / F.col("cases"))


def category_mix_by_month(closed: DataFrame) -> DataFrame:
    """Cases and share per month and category: a drift here can pass for a trend in durations."""
    counts = closed.groupBy("intake_month", "category").agg(F.count("*").alias("cases"))
    whole = F.sum("cases").over(Window.partitionBy("intake_month"))
    return counts.withColumn("share", F.col("cases") / whole)


def sparse_cells(closed: DataFrame, minimum: int = 30) -> DataFrame:
    """Category × priority cells too small to model an interaction."""
    counts = closed.groupBy("category", "priority").agg(F.count("*").alias("cases"))
    return counts.withColumn("too_small", F.col("cases") < minimum)
