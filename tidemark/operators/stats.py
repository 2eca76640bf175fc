"""Hypothesis tests on sufficient statistics.

Every test takes segment columns ``by``, so thousands of tests are one job. Rows are aggregated first;
p-values are computed on the aggregate, one row per test.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.tails import chi2_p, f_p, rank_sum_p, student_p
from tidemark.operators.ranks import count_values, join_by, rank_counts, ranked_values, sample_std, segment_stats

DURATION_WIDTH = 365.0


def linear_trend(df: DataFrame, x: Column, y: Column, by: Sequence[str] = ()) -> DataFrame:
    """Ordinary least squares of y on x: n, slope, intercept, r2, std_err, t, p_value."""
    sums = (
        df.select(*by, x.cast("double").alias("x"), y.cast("double").alias("y"))
        .groupBy(*by)
        .agg(
            F.regr_count("y", "x").alias("n"),
            F.regr_slope("y", "x").alias("slope"),
            F.regr_intercept("y", "x").alias("intercept"),
            F.regr_r2("y", "x").alias("r2"),
            F.regr_sxx("y", "x").alias("sxx"),
            F.regr_syy("y", "x").alias("syy"),
        )
    )
    df_ = F.col("n") - 2
    err = F.when((df_ > 0) & (F.col("sxx") > 0), F.sqrt((1 - F.col("r2")) * F.col("syy") / F.col("sxx") / df_))
    # A perfect fit has no error, hence no finite t; a flat line isn't a trend.
    exact = (df_ > 0) & (F.col("std_err") == 0) & (F.col("slope") != 0)
    return (
        sums.withColumn("std_err", err)
        .withColumn("t", F.try_divide("slope", "std_err"))
        .withColumn("p_value", F.when(exact, F.lit(0.0)).otherwise(student_p(F.col("t"), df_.cast("double"))))
        .drop("sxx", "syy")
    )


def group_breakdown(df: DataFrame, value: str, by: Sequence[str], width: float | None = None) -> DataFrame:
    """count, mean, median and sample standard deviation per group."""
    return segment_stats(ranked_values(df, value, by, width), by)


def kruskal_wallis(df: DataFrame, value: str, group: str, by: Sequence[str] = (), width: float | None = None) -> DataFrame:
    """Tie-corrected H with its chi-square tail; a single group gives H = 0 and p = 1. Rows without a group are left out."""
    by = list(by)
    cells = count_values(df.where(F.col(group).isNotNull()), value, [*by, group]).withColumnRenamed("n", "cell_n")
    pooled = cells.groupBy(*by, "value").agg(F.sum("cell_n").alias("n"))
    ranked = rank_counts(pooled, by, width).withColumn("ties", F.pow(F.col("n").cast("double"), F.lit(3)) - F.col("n"))
    sums = (
        join_by(cells, ranked.select(*by, "value", "mid_rank", "total"), by, ["value"])
        .groupBy(*by, group)
        .agg(F.sum("cell_n").alias("size"), F.sum(F.col("cell_n") * F.col("mid_rank")).alias("rank_sum"), F.max("total").alias("total"))
    )
    tied = ranked.groupBy(*by).agg(F.sum("ties").alias("ties"))
    tested = sums.groupBy(*by).agg(
        F.max("total").alias("n"),
        F.count("*").alias("groups"),
        F.sum(F.col("size") * F.pow(F.col("rank_sum") / F.col("size") - (F.col("total") + 1) / F.lit(2.0), F.lit(2))).alias("spread"),
    )
    tested = join_by(tested, tied, by) if by else tested.withColumn("ties", tied.scalar())
    n = F.col("n").cast("double")
    raw = F.lit(12.0) / (n * (n + 1)) * F.col("spread")
    corrected = F.try_divide(raw, 1 - F.col("ties") / (n * n * n - n))
    return (
        tested.withColumn("h_stat", F.when(F.col("groups") > 1, corrected).otherwise(F.lit(0.0)))
        .withColumn("p_value", F.when(F.col("groups") > 1, chi2_p(F.col("h_stat"), (F.col("groups") - 1).cast("double"))).otherwise(F.lit(1.0)))
        .select(*by, "n", "groups", "h_stat", "p_value")
    )


def spearman(
    df: DataFrame, x: str, y: str, by: Sequence[str] = (), x_width: float | None = None, y_width: float | None = None
) -> DataFrame:
    """Rank correlation: Pearson on mid-ranks, p from t with n − 2."""
    by = list(by)
    cells = (
        df.select(*by, F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
        .where(F.col("x").isNotNull() & F.col("y").isNotNull())
        .groupBy(*by, "x", "y")
        .agg(F.count("*").alias("cell_n"))
    )

    def ranks(side: str, width: float | None) -> DataFrame:
        pooled = cells.groupBy(*by, F.col(side).alias("value")).agg(F.sum("cell_n").alias("n"))
        ranked = rank_counts(pooled, by, width)
        off = F.col("mid_rank") - (F.col("total") + F.lit(1)) / F.lit(2.0)
        return ranked.select(*by, F.col("value").alias(side), off.alias(f"{side}_off"), F.col("total").alias(f"{side}_total"))

    joined = join_by(join_by(cells, ranks("x", x_width), by, ["x"]), ranks("y", y_width).drop("y_total"), by, ["y"])
    sums = joined.groupBy(*by).agg(
        F.max("x_total").alias("n"),
        F.sum(F.col("cell_n") * F.col("x_off") * F.col("y_off")).alias("sxy"),
        F.sum(F.col("cell_n") * F.col("x_off") * F.col("x_off")).alias("sxx"),
        F.sum(F.col("cell_n") * F.col("y_off") * F.col("y_off")).alias("syy"),
    )
    rho = F.try_divide(F.col("sxy"), F.sqrt(F.col("sxx") * F.col("syy")))
    t = F.col("rho") * F.sqrt(F.try_divide(F.col("n") - F.lit(2), (1 - F.col("rho")) * (1 + F.col("rho"))))
    p = F.when(F.abs("rho") >= 1, F.lit(0.0)).otherwise(student_p(t, (F.col("n") - 2).cast("double")))
    return sums.withColumn("rho", rho).withColumn("p_value", p).select(*by, "n", "rho", "p_value")


def two_arm_tests(df: DataFrame, value: str, arm: Column, by: Sequence[str] = (), width: float | None = None) -> DataFrame:
    """Mann–Whitney U (of the first arm) and Welch t between two arms, with the arms' summaries.

    ``arm`` is a boolean: true rows are arm 1, false rows arm 2; rows without an arm are left out.
    """
    by = list(by)
    cells = count_values(df.withColumn("arm", arm).where(F.col("arm").isNotNull()), value, [*by, "arm"]).withColumnRenamed("n", "cell_n")
    pooled = cells.groupBy(*by, "value").agg(F.sum("cell_n").alias("n"))
    ranked = rank_counts(pooled, by, width)
    tied = ranked.groupBy(*by).agg(F.sum(F.pow(F.col("n").cast("double"), F.lit(3)) - F.col("n")).alias("ties"))
    rank_sum = (
        join_by(cells.where(F.col("arm")), ranked.select(*by, "value", "mid_rank"), by, ["value"])
        .groupBy(*by).agg(F.sum(F.col("cell_n") * F.col("mid_rank")).alias("rank_sum"))
    )
    arms = rank_counts(cells.withColumnRenamed("cell_n", "n"), [*by, "arm"], width)
    summary = segment_stats(arms, [*by, "arm"])

    def of(flag: bool, column: str) -> Column:
        side = F.col("arm") if flag else ~F.col("arm")
        return F.max(F.when(side, F.col(column))).alias(f"{column}_{1 if flag else 2}")

    wide = summary.groupBy(*by).agg(*[of(f, c) for f in (True, False) for c in ("count", "mean", "median", "std")])
    if by:
        wide = join_by(join_by(wide, tied, by, how="left"), rank_sum, by, how="left")
    else:
        wide = wide.withColumn("ties", tied.scalar()).withColumn("rank_sum", rank_sum.scalar())
    n1, n2 = F.col("count_1").cast("double"), F.col("count_2").cast("double")
    se1, se2 = F.try_divide(F.col("std_1") * F.col("std_1"), n1), F.try_divide(F.col("std_2") * F.col("std_2"), n2)
    return (
        wide.fillna(0, ["count_1", "count_2"])
        .withColumn("u_stat", F.when((n1 > 0) & (n2 > 0), F.col("rank_sum") - n1 * (n1 + 1) / 2))
        .withColumn("u_p", rank_sum_p(F.col("u_stat"), n1, n2, F.col("ties")))
        .withColumn("welch_t", F.try_divide(F.col("mean_1") - F.col("mean_2"), F.sqrt(se1 + se2)))
        .withColumn("welch_df", F.try_divide((se1 + se2) * (se1 + se2), F.try_divide(se1 * se1, n1 - 1) + F.try_divide(se2 * se2, n2 - 1)))
        .withColumn("welch_p", student_p("welch_t", "welch_df"))
        .drop("rank_sum", "ties")
    )


def box_stats(df: DataFrame, value: str, by: Sequence[str], width: float | None = None) -> DataFrame:
    """Quartiles, 1.5 IQR whiskers and outlier count per group."""
    from tidemark.operators.ranks import quantile

    ranked = ranked_values(df, value, by, width)
    boxes = ranked.groupBy(*by).agg(
        F.sum("n").alias("count"), F.max("mean").alias("mean"),
        quantile(0.25).alias("q1"), quantile(0.5).alias("median"), quantile(0.75).alias("q3"),
    )
    reach = F.lit(1.5) * (F.col("q3") - F.col("q1"))
    low, high = F.col("q1") - reach, F.col("q3") + reach
    inside = F.col("value").between(low, high)
    spread = (
        join_by(ranked.select(*by, "value", "n"), boxes.select(*by, "q1", "q3"), by)
        .groupBy(*by)
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)).alias("outliers"),
        )
    )
    return join_by(boxes, spread, by)


def box_outliers(df: DataFrame, value: str, by: Sequence[str], width: float | None = None, limit: int = 5) -> DataFrame:
    """The values beyond the whiskers' reach: per group and side the ``limit`` most extreme, with how many rows hold each."""
    from tidemark.operators.ranks import quantile

    ranked = ranked_values(df, value, by, width)
    quartiles = ranked.groupBy(*by).agg(quantile(0.25).alias("q1"), quantile(0.75).alias("q3"))
    reach = F.lit(1.5) * (F.col("q3") - F.col("q1"))
    side = F.when(F.col("value") < F.col("q1") - reach, "low").when(F.col("value") > F.col("q3") + reach, "high")
    far = join_by(ranked.select(*by, "value", "n"), quartiles, by).withColumn("side", side).where(F.col("side").isNotNull())
    beyond = F.when(F.col("side") == "low", -F.col("value")).otherwise(F.col("value"))
    # A task hands on at most ``limit`` values a group and side.
    place = Window.partitionBy(*by, "side").orderBy(beyond.desc())
    return far.withColumn("place", F.row_number().over(place)).where(F.col("place") <= limit).select(*by, "side", "place", "value", F.col("n").alias("rows"))


__all__ = [
    "box_outliers", "box_stats", "f_p", "group_breakdown", "kruskal_wallis", "linear_trend", "sample_std", "spearman", "two_arm_tests",
]
