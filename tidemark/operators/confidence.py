"""Confidence scores for the three findings, as column expressions over their rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.findings import CANNOT_ANSWER
from tidemark.operators.ranks import join_by


def data_health(quality_score: Column, raw_n: Column, clean_n: Column) -> Column:
    """0 to 30: seven tenths quality score, three tenths retention."""
    return F.bround(quality_score / 100 * 21 + F.least(F.lit(100.0), _retention(raw_n, clean_n)) / 100 * 9, 2)


def _retention(raw_n: Column, clean_n: Column) -> Column:
    return clean_n / F.greatest(F.lit(1), raw_n) * 100


def _graded(p: Column, steps: list[tuple[float, float]]) -> Column:
    out = F.lit(0.0)
    for limit, points in reversed(steps):
        out = F.when(p < limit, F.lit(points)).otherwise(out)
    return out


def _reached(value: Column, steps: list[tuple[float, float]]) -> Column:
    out = F.lit(0.0)
    for limit, points in reversed(steps):
        out = F.when(value >= limit, F.lit(points)).otherwise(out)
    return out


def _card(df: DataFrame, by: Sequence[str], sample: Column, health: Column, power: Column, penalty: Column, grade) -> DataFrame:
    """One scorecard row; a finding that could not be answered scores zero throughout."""
    dead = F.col("confidence_level") == CANNOT_ANSWER
    total = F.greatest(F.lit(0.0), F.least(F.lit(100.0), F.bround(sample + health + power - penalty, 1)))
    zero = lambda c: F.when(dead, F.lit(0.0)).otherwise(c)
    return df.select(
        *by,
        "question_id",
        F.when(dead, CANNOT_ANSWER).otherwise(grade(total)).alias("overall_confidence"),
        zero(total).alias("confidence_score"),
        zero(F.bround(sample, 1)).alias("sample_size_score"),
        zero(F.bround(health, 1)).alias("data_quality_score"),
        zero(F.bround(power, 1)).alias("statistical_power_score"),
        zero(F.bround(penalty, 1)).alias("confounding_penalty"),
    )


def _by_score(total: Column) -> Column:
    return F.when(total >= 80, "HIGH").when(total >= 55, "MEDIUM").otherwise("LOW")


def trend_confidence(finding: DataFrame, quality_score: Column, raw_n: Column, clean_n: Column, by: Sequence[str] = ()) -> DataFrame:
    p = F.col("p_value")
    sample = F.least(F.lit(30.0), F.col("cohorts") / 12 * 15 + clean_n / 100 * 15)
    power = _graded(p, [(0.001, 20.0), (0.01, 15.0), (0.05, 10.0)]) + _reached(
        F.col("r_squared"), [(0.20, 10.0), (0.10, 6.0), (0.05, 3.0)])
    penalty = F.when(F.col("cohorts") < 6, 5.0).otherwise(0.0) + F.when(100 - _retention(raw_n, clean_n) > 10, 5.0).otherwise(0.0)
    grade = lambda total: (
        F.when((total >= 80) & (p < 0.01), "HIGH").when((total >= 55) & (p < 0.05), "MEDIUM").otherwise("LOW"))
    return _card(finding, by, sample, data_health(quality_score, raw_n, clean_n), power, penalty, grade)


def driver_confidence(
    finding: DataFrame, quality_score: Column, raw_n: Column, clean_n: Column, by: Sequence[str] = (), penalty: float = 5.0
) -> DataFrame:
    strong = (F.col("kw_p") < 0.001) & (F.col("spearman_p") < 0.001)
    power = F.when(strong, 20.0).when(F.col("kw_p") < 0.05, 12.0).otherwise(0.0) + _reached(
        F.col("adj_r_squared"), [(0.30, 10.0), (0.15, 6.0)])
    sample = F.least(F.lit(30.0), clean_n / 100 * 30)
    return _card(finding, by, sample, data_health(quality_score, raw_n, clean_n), power, F.lit(penalty), _by_score)


def triage_confidence(
    finding: DataFrame, crosstab: DataFrame, quality_score: Column, raw_n: Column, clean_n: Column,
    by: Sequence[str] = (), confounder: str = "Hardware", by_share: bool = False,
) -> DataFrame:
    """The confounder costs points when its category occurs at all among the urgent cases, or, ``by_share``, only when
    it is a larger share of the untriaged than of the triaged cases."""
    named = F.col("category").contains(confounder)
    share = lambda c: F.coalesce(F.try_divide(F.sum(F.when(named, F.col(c)).otherwise(0)), F.sum(c)), F.lit(0.0))
    confounded = share("untriaged") > share("triaged") if by_share else F.max(named)
    seen = crosstab.groupBy(*by).agg(confounded.alias("confounded"))
    rows = join_by(finding, seen, by, how="left") if by else finding.withColumn("confounded", seen.scalar())
    n2 = F.col("untriaged_n")
    sample = F.least(F.lit(30.0), (F.col("triaged_n") + n2) / 40 * 30)
    power = _graded(F.col("mann_whitney_p"), [(0.001, 25.0), (0.01, 20.0), (0.05, 12.0)])
    penalty = F.when(n2 < 10, 8.0).otherwise(0.0) + F.when(F.coalesce("confounded", F.lit(False)), 4.0).otherwise(0.0)
    return _card(rows, by, sample, data_health(quality_score, raw_n, clean_n), power, penalty, _by_score)


def scorecard(
    trend: DataFrame, drivers: DataFrame, triage: DataFrame, crosstab: DataFrame,
    quality_score: Column, raw_n: Column, clean_n: Column, by: Sequence[str] = (),
) -> DataFrame:
    """All three scorecards as one table."""
    facts = (quality_score, raw_n, clean_n)
    return (
        trend_confidence(trend, *facts, by=by)
        .unionByName(driver_confidence(drivers, *facts, by=by))
        .unionByName(triage_confidence(triage, crosstab, *facts, by=by))
    )
