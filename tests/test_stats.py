"""Profile, ranks, tests and scores against plain Python and known values."""

from __future__ import annotations

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import tails
from tidemark.operators import findings, profile, ranks, stats
from tidemark.operators.regression import factor_regression


def test_profile_fixture(rows):
    df = rows(id=["1", "2", "3", "4", "4"], category=["A", "B", "A", "B", "B"], count=["10", "", "30", "40", "40"], flag=["yes", "no", "yes", "no", "no"])
    whole = profile.dataset_profile(df).first()
    assert (whole.exact_duplicate_rows, whole.exact_duplicate_percentage) == (1, 20.0)
    got = {r.column_name: r for r in profile.column_profile(df).collect()}
    assert (got["count"].missing_count, got["count"].missing_percentage) == (1, 20.0)
    assert (got["flag"].inferred_type, got["category"].inferred_type, got["id"].inferred_type) == ("boolean", "categorical", "numeric")


def test_tails():
    assert tails.student_two_sided(2.228138852, 10) == pytest.approx(0.05, rel=1e-8)
    assert tails.chi2_upper(3.841458821, 1) == pytest.approx(0.05, rel=1e-8)
    assert tails.chi2_upper(200.0, 2) == pytest.approx(math.exp(-100), rel=1e-10)
    assert tails.f_upper(4.964602744, 1, 10) == pytest.approx(0.05, rel=1e-8)


@pytest.mark.parametrize("n1,n2", [(3, 4), (5, 2), (8, 6)])
def test_exact_rank_sum_by_enumeration(n1, n2):
    us = [sum(c) - n1 * (n1 + 1) // 2 for c in itertools.combinations(range(1, n1 + n2 + 1), n1)]
    for u in (0, 1, n1 * n2 // 2, n1 * n2):
        top = max(u, n1 * n2 - u)
        want = min(1.0, 2 * sum(x >= top for x in us) / len(us))
        assert tails.rank_sum_exact(u, n1, n2) == pytest.approx(want, rel=1e-12)


def test_ranks_do_not_depend_on_buckets(spark, monkeypatch):
    random.seed(5)
    data = [(random.choice("ab"), round(random.expovariate(0.1), 1)) for _ in range(2000)]
    df = spark.createDataFrame(data, "g string, v double")
    want = {}
    for g in "ab":
        values = sorted(v for k, v in data if k == g)
        for v in set(values):
            at = [i + 1 for i, x in enumerate(values) if x == v]
            want[g, v] = sum(at) / len(at)
    for limit, width in ((10**6, None), (10, None), (10**6, 3.0)):
        monkeypatch.setattr(ranks, "ONE_BUCKET_LIMIT", limit)
        got = {(r.g, r.value): r.mid_rank for r in ranks.ranked_values(df, "v", ["g"], width).collect()}
        assert got == want
        whole = ranks.segment_stats(ranks.ranked_values(df, "v", width=width)).first()
        values = [v for _, v in data]
        assert (whole["count"], whole.median) == (2000, pytest.approx(np.median(values)))
        assert (whole["mean"], whole["std"]) == (pytest.approx(np.mean(values)), pytest.approx(np.std(values, ddof=1)))


def test_full_buckets_are_cut_until_none_is_over_the_limit(spark, monkeypatch):
    monkeypatch.setattr(ranks, "ONE_BUCKET_LIMIT", 20)
    monkeypatch.setattr(ranks, "_EDGES", 3)
    rng = random.Random(9)
    values = [rng.choice([rng.uniform(-1e9, 1e9), rng.uniform(0, 1e-9), rng.randint(0, 40) / 8]) for _ in range(1500)]
    df = spark.createDataFrame([(v, "big" if i % 10 else None) for i, v in enumerate(values)], "v double, g string").repartition(5)
    placed = ranks._bucketed(ranks.count_values(df, "v", ["g"]), ["g"], None)
    sizes = placed.groupBy("g", "bucket").count().collect()
    assert max(r["count"] for r in sizes) <= 20 and max(len(r.bucket) for r in sizes) > 3
    for g in ("big", None):
        mine = sorted((r.bucket, r.value) for r in placed.collect() if r.g == g)
        assert [v for _, v in mine] == sorted(v for _, v in mine)
    got = {(r.g, r.value): r.mid_rank for r in ranks.ranked_values(df, "v", ["g"]).collect()}
    for g, keep in (("big", [v for i, v in enumerate(values) if i % 10]), (None, values[::10])):
        keep.sort()
        assert all(got[g, v] == (2 * keep.index(v) + keep.count(v) + 1) / 2 for v in set(keep))
    assert ranks._bucketed(ranks.count_values(df.limit(0), "v"), [], None).count() == 0


def test_outliers_are_listed_from_the_far_end(spark):
    data = [("a", float(v)) for v in [*range(20), 100, 100, 300, -90]] + [("b", 1.0), ("b", 2.0), (None, 1.0)]
    got = stats.box_outliers(spark.createDataFrame(data, "g string, v double"), "v", ["g"], limit=2).collect()
    assert sorted(tuple(r) for r in got) == [("a", "high", 1, 300.0, 1), ("a", "high", 2, 100.0, 2), ("a", "low", 1, -90.0, 1)]


def test_solver_ends_on_a_path_of_levels_and_says_how_well(spark):
    """Each level of one factor meets two neighbours of the other, which is as badly connected as levels can be."""
    rng = random.Random(4)
    data = [(f"a{i}", f"b{i + j}", rng.randrange(9), rng.random() < 0.5, rng.gauss(i, 1)) for i in range(14) for j in (0, 1) for _ in range(3)]
    df = spark.createDataFrame(data, "a string, b string, x int, z boolean, y double")
    fit = lambda **k: factor_regression(df, "y", "a", "b", "x", "z", **k).first()
    exact, solved, cut = fit(), fit(dense_levels=2), fit(dense_levels=2, max_steps=2)
    assert exact.residual == 0.0 and solved.residual < 1e-10 and cut.residual > 1e-6
    assert (solved.n, solved.model_df) == (exact.n, exact.model_df) and solved.r2 == pytest.approx(exact.r2, rel=1e-8)


def test_regression_equals_least_squares(spark):
    random.seed(2)
    data = [(random.choice("xyz"), random.choice(["lo", "hi"]), random.randint(0, 9), random.random() < 0.5, random.gauss(5, 2)) for _ in range(80)]
    df = spark.createDataFrame(data, "c string, p string, n int, t boolean, y double")
    got = factor_regression(df, "y", "c", "p", "n", "t").first()
    design = np.array([[1, c == "y", c == "z", p == "lo", n, t] for c, p, n, t, _ in data], dtype=float)
    y = np.array([r[-1] for r in data])
    rss = ((y - design @ np.linalg.lstsq(design, y, rcond=None)[0]) ** 2).sum()
    r2 = 1 - rss / ((y - y.mean()) ** 2).sum()
    assert (got.n, got.model_df, got.resid_df) == (80, 5, 74)
    assert got.r2 == pytest.approx(r2) and got.adj_r2 == pytest.approx(1 - (1 - r2) * 79 / 74)


def test_two_arms_and_kruskal(spark):
    df = spark.createDataFrame([(True, v) for v in [1.0, 2.0, 2.0, 3.0]] + [(False, v) for v in [4.0, 5.0, 6.0]], "arm boolean, v double")
    got = stats.two_arm_tests(df, "v", F.col("arm")).first()
    assert got.u_stat == 0.0 and got.welch_t == pytest.approx((2.0 - 5.0) / math.sqrt((2 / 3) / 4 + 1 / 3))
    one = stats.kruskal_wallis(df.withColumn("g", F.lit("only")), "v", "g").first()
    assert (one.h_stat, one.p_value) == (0.0, 1.0)


def test_sparse_data_cannot_answer(spark):
    cleaned = spark.createDataFrame(
        [("Closed", "2024-01-01", 4.0, "Billing", "High", 2, True), ("Closed", "2024-01-02", 5.0, "Billing", "High", 3, False)],
        "status string, intake_date string, duration_days double, category string, priority string, contact_count int, triaged boolean",
    )
    closed = findings.closed_cases(cleaned)
    for finding in (findings.trend_finding, findings.driver_finding, findings.triage_finding):
        assert finding(closed).first().verdict == "CANNOT ANSWER"


def test_rank_sum_does_not_jump_with_the_larger_arm():
    small, one_more = (tails.rank_sum_two_sided(0.0, 8.0, n, 0.0) for n in (1_250_000.0, 1_250_001.0))
    assert small == pytest.approx(1.3528757e-44, rel=1e-6) and one_more == pytest.approx(small, rel=1e-4)
    assert tails.rank_sum_two_sided(5.1e6, 2.0, 5_100_000.0, 0.0) == pytest.approx(tails.rank_sum_two_sided(4e6, 2.0, 4_000_000.0, 0.0), rel=1e-3)


def test_tails_keep_their_digits_with_many_degrees_of_freedom():
    for df in (1e8, 1e10, 1e12):
        assert tails.student_two_sided(2.0, df) == pytest.approx(math.erfc(math.sqrt(2.0)), rel=1e-7)
    assert tails.student_two_sided(8.5, 1e12) == pytest.approx(math.erfc(8.5 / math.sqrt(2.0)), rel=1e-7)


def test_perfect_fit_is_significant(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i, 5.0) for i in range(20)], "x double, y double, flat double")
    assert stats.linear_trend(df, F.col("x"), F.col("y")).first().p_value == 0.0
    flat = stats.linear_trend(df, F.col("x"), F.col("flat")).first()
    assert flat.slope == 0 and flat.p_value != 0.0


def test_null_segments_are_segments(spark):
    data = [(s, g, v, 2.0 * v) for s in ("a", None) for g, v in [("x", 1.0), ("x", 2.0), ("y", 3.0), ("y", 4.0)]]
    df = spark.createDataFrame(data, "s string, g string, v double, w double")
    for table in (
        stats.kruskal_wallis(df, "v", "g", ["s"]),
        stats.spearman(df, "v", "w", ["s"]),
        stats.box_stats(df, "v", ["s"]),
        stats.two_arm_tests(df, "v", F.col("g") == "x", ["s"]),
        stats.linear_trend(df, F.col("v"), F.col("w"), ["s"]),
    ):
        rows = [tuple(r[1:]) for r in table.collect()]
        assert len(rows) == 2 and rows[0] == rows[1]


def test_rows_without_an_arm_or_group_are_left_out(spark):
    data = [(True, 1.0), (True, 2.0), (False, 3.0), (False, 4.0)]
    df = spark.createDataFrame([*data, (None, 0.5), (None, 0.6), (None, 0.7)], "arm boolean, v double")
    got = stats.two_arm_tests(df, "v", F.col("arm")).first()
    assert got.u_stat == 0.0 and (got.count_1, got.count_2) == (2, 2)
    assert stats.kruskal_wallis(df, "v", "arm").first().n == 4


@pytest.mark.parametrize("dense_levels", [4096, 3])
def test_regression_with_many_levels_of_both_factors(spark, dense_levels):
    """Dense and iterative solutions against numpy, with a segment of NULL and factors in two separate parts."""
    rng = random.Random(2)
    data = []
    for s in ("u", None):
        for _ in range(400):
            part = rng.choice("pq")
            a, b = f"{part}{rng.randrange(12)}", f"{part}{rng.randrange(8)}"
            x, z = rng.randrange(20), rng.random() < 0.4
            data.append((s, a, b, x, z, 1e6 + 3.0 * x + 5 * z + len(a) * int(a[1:]) % 7 + rng.gauss(0, 4)))
    df = spark.createDataFrame(data, "seg string, a string, b string, x int, z boolean, y double")
    got = {r.seg: r for r in factor_regression(df, "y", "a", "b", "x", "z", ["seg"], dense_levels=dense_levels).collect()}
    for s in ("u", None):
        mine = [d for d in data if d[0] == s]
        y = np.array([d[5] for d in mine])
        columns = [[float(d[1] == a) for d in mine] for a in sorted({d[1] for d in mine})]
        columns += [[float(d[2] == b) for d in mine] for b in sorted({d[2] for d in mine})]
        m = np.array([*columns, [d[3] for d in mine], [float(d[4]) for d in mine]]).T
        rank = np.linalg.matrix_rank(m)
        rss = ((y - m @ np.linalg.lstsq(m, y, rcond=None)[0]) ** 2).sum()
        r2 = 1 - rss / ((y - y.mean()) ** 2).sum()
        assert (got[s].n, got[s].model_df) == (400, rank - 1)
        assert got[s].r2 == pytest.approx(r2, rel=1e-8)
