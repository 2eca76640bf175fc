"""The three questions asked of a cleaned table, each answered by one row per segment.

Q1: have closure times risen? Q2: what drives them? Q3: does triage shorten urgent cases?
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import vocab
from tidemark.functions.dates import month_key, ordinal_day
from tidemark.operators.ranks import join_by
from tidemark.operators.regression import factor_regression
from tidemark.operators.stats import DURATION_WIDTH, group_breakdown, kruskal_wallis, linear_trend, spearman, two_arm_tests

CANNOT_ANSWER = "CANNOT ANSWER"


def closed_cases(cleaned: DataFrame) -> DataFrame:
    """Closed cases with a usable duration, plus intake month and day number."""
    return cleaned.where((F.lower("status") == "closed") & (F.col("duration_days") >= 0)).withColumns(
        {
            "intake_month": month_key(F.col("intake_date").cast("date")),
            "intake_ordinal": ordinal_day(F.col("intake_date").cast("date")),
        }
    )


def urgent_cases(closed: DataFrame) -> DataFrame:
    return closed.where(F.col("priority").isin(*vocab.HIGH_URGENCY))


def complete_cases(closed: DataFrame) -> DataFrame:
    """Rows with all model columns filled."""
    return closed.na.drop(subset=["duration_days", "category", "priority", "contact_count"])


def monthly_cohorts(closed: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """count, mean, median and std of durations per intake month (unrounded)."""
    return group_breakdown(closed, "duration_days", [*by, "intake_month"], DURATION_WIDTH)


def _attach(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Join two one-row-per-segment tables."""
    if by:
        return join_by(left, right, by, how="left")
    row = right.select(F.struct(*right.columns)).scalar()
    return left.withColumn("_row", row).select(*left.columns, *[F.col(f"_row.{c}").alias(c) for c in right.columns])


def trend_finding(closed: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Q1: regression of duration on intake day, first and last cohort, verdict and level."""
    by = list(by)
    trend = linear_trend(closed, F.col("intake_ordinal"), F.col("duration_days"), by)
    cohorts = (
        closed.groupBy(*by, "intake_month").agg(F.avg("duration_days").alias("m")).groupBy(*by).agg(
            F.count("*").alias("cohorts"),
            F.min("intake_month").alias("first_month"),
            F.max("intake_month").alias("last_month"),
            F.bround(F.min_by("m", "intake_month"), 2).alias("first_month_mean"),
            F.bround(F.max_by("m", "intake_month"), 2).alias("last_month_mean"),
        )
    )
    p, slope = F.col("p_value"), F.col("slope")
    enough = F.col("n") >= 10
    joined = _attach(trend, cohorts, by)
    return joined.select(
        *by,
        F.lit("Q1").alias("question_id"),
        "n",
        "cohorts",
        F.bround(slope * vocab.DAYS_PER_MONTH, 3).alias("monthly_slope_days"),
        F.bround("r2", 4).alias("r_squared"),
        "p_value",
        F.bround(F.col("std_err") * vocab.DAYS_PER_MONTH, 4).alias("std_err"),
        "first_month", "last_month", "first_month_mean", "last_month_mean",
        F.bround(F.col("last_month_mean") - F.col("first_month_mean"), 2).alias("mean_increase"),
        F.when(~enough, CANNOT_ANSWER)
        .when((slope > 0) & (p < 0.05), "YES")
        .when((slope < 0) & (p < 0.05), "NO")
        .otherwise("INCONCLUSIVE / NO SIGNIFICANT INCREASE")
        .alias("verdict"),
        F.when(~enough, CANNOT_ANSWER).when(p < 0.01, "HIGH").when(p < 0.05, "MEDIUM").otherwise("LOW").alias("confidence_level"),
    )


def category_durations(closed: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Durations per category of each segment, slowest first."""
    return group_breakdown(complete_cases(closed), "duration_days", [*by, "category"], DURATION_WIDTH).orderBy(*by, F.desc("mean"), "category")


def priority_durations(closed: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Durations per priority of each segment, slowest first."""
    return group_breakdown(complete_cases(closed), "duration_days", [*by, "priority"], DURATION_WIDTH).orderBy(*by, F.desc("mean"), "priority")


def driver_finding(closed: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Q2: Kruskal–Wallis over categories, Spearman with contacts, the full regression, extreme groups."""
    by = list(by)
    rows = complete_cases(closed)
    kw = kruskal_wallis(rows, "duration_days", "category", by, DURATION_WIDTH).select(
        *by, "n", F.col("h_stat"), F.col("p_value").alias("kw_p"))
    rho = spearman(rows, "contact_count", "duration_days", by, x_width=1000.0, y_width=DURATION_WIDTH).select(
        *by, "rho", F.col("p_value").alias("spearman_p"))
    ols = factor_regression(rows, "duration_days", "category", "priority", "contact_count", "triaged", by).select(
        *by, "adj_r2", F.col("f_p").alias("f_pvalue"))
    means = rows.groupBy(*by, "category").agg(F.avg("duration_days").alias("m"))
    ends = means.groupBy(*by).agg(
        F.min(F.struct((-F.col("m")).alias("m"), "category")).alias("top"), F.max(F.struct((-F.col("m")).alias("m"), "category")).alias("low")
    ).select(
        *by,
        F.col("top.category").alias("top_category"), F.bround(-F.col("top.m"), 2).alias("top_category_mean"),
        F.col("low.category").alias("bottom_category"), F.bround(-F.col("low.m"), 2).alias("bottom_category_mean"),
    )
    joined = _attach(_attach(_attach(kw, rho, by), ols, by), ends, by)
    enough = F.coalesce(F.col("n"), F.lit(0)) >= 20
    return joined.select(
        *by,
        F.lit("Q2").alias("question_id"),
        F.coalesce("n", F.lit(0)).alias("n"),
        F.bround("h_stat", 3).alias("h_stat"), "kw_p", (F.col("kw_p") < 0.05).alias("kw_significant"),
        F.bround("rho", 3).alias("rho"), "spearman_p",
        F.bround("adj_r2", 4).alias("adj_r_squared"), "f_pvalue",
        "top_category", "top_category_mean", "bottom_category", "bottom_category_mean",
        F.when(enough, "PRIMARY DRIVERS").otherwise(CANNOT_ANSWER).alias("verdict"),
        F.when(enough, "HIGH").otherwise(CANNOT_ANSWER).alias("confidence_level"),
    )


def triage_crosstab(closed: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Urgent cases per category and triage state, zero filled."""
    rows = urgent_cases(closed)
    return rows.groupBy(*by, "category").agg(
        F.count_if(~F.col("triaged")).alias("untriaged"), F.count_if(F.col("triaged")).alias("triaged")
    )


def triage_finding(closed: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Q3: triaged against untriaged urgent cases."""
    by = list(by)
    tests = two_arm_tests(urgent_cases(closed), "duration_days", F.col("triaged"), by, DURATION_WIDTH)
    mean_1, mean_2 = F.bround("mean_1", 2), F.bround("mean_2", 2)
    n1, n2 = F.col("count_1"), F.col("count_2")
    able = (n1 + n2 >= 10) & (n1 > 0) & (n2 > 0)
    works = (F.col("u_p") < 0.05) & (mean_1 < mean_2)
    return tests.select(
        *by,
        F.lit("Q3").alias("question_id"),
        n1.alias("triaged_n"), mean_1.alias("triaged_mean"), F.bround("median_1", 2).alias("triaged_median"),
        F.coalesce(F.bround("std_1", 2), F.lit(0.0)).alias("triaged_std"),
        n2.alias("untriaged_n"), mean_2.alias("untriaged_mean"), F.bround("median_2", 2).alias("untriaged_median"),
        F.coalesce(F.bround("std_2", 2), F.lit(0.0)).alias("untriaged_std"),
        F.bround(mean_2 - mean_1, 2).alias("mean_difference_days"),
        F.when(mean_2 > 0, F.bround((mean_2 - mean_1) / mean_2 * 100, 2)).otherwise(F.lit(0.0)).alias("percentage_reduction"),
        F.col("u_stat").alias("mann_whitney_u"), F.col("u_p").alias("mann_whitney_p"),
        (F.col("u_p") < 0.05).alias("significant"),
        F.bround("welch_t", 3).alias("welch_t_stat"), F.col("welch_p").alias("welch_t_p"),
        F.when(~able, CANNOT_ANSWER).when(works, "YES").otherwise("MODERATE / INCONCLUSIVE EFFECT").alias("verdict"),
        F.when(~able, CANNOT_ANSWER)
        .when(works, F.when(F.col("u_p") < 0.01, "HIGH").otherwise("MEDIUM"))
        .otherwise(F.when(n2 >= 5, "MEDIUM").otherwise("LOW"))
        .alias("confidence_level"),
    )
