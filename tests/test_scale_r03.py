"""What keeps tasks even and shuffles small on large tables, shown on small ones."""

from __future__ import annotations

import random
import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from tidemark.operators import duplicates, profile, regression
from tidemark.operators.cleaning import clean
from tidemark.operators.keyed import with_key_counts, with_key_stats


@contextmanager
def settings(spark, **conf):
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


SHUFFLED = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}


def test_null_keys_are_dealt_to_all_partitions(spark):
    df = spark.range(400).select("id", F.when(F.col("id") < 4, F.lit("k")).alias("key"))
    with settings(spark, **SHUFFLED):
        got = with_key_stats(df, "key", {"low": F.min("id")}).withColumn("p", F.spark_partition_id()).collect()
        counted = with_key_counts(df, {"key": "rows"}).withColumn("p", F.spark_partition_id()).collect()
    assert {(r.id, r.key_rows, r.low) for r in got} == {(i, 4, 0) if i < 4 else (i, None, None) for i in range(400)}
    assert {(r.id, r.rows) for r in counted} == {(i, 4 if i < 4 else None) for i in range(400)}
    for found in (got, counted):
        assert len({r.p for r in found if r.key is None}) > 4


def test_both_sides_of_the_key_join_come_from_a_shuffle(spark):
    """Adaptive execution splits a hot partition only then."""
    df = spark.range(40).select("id", (F.col("id") % 3).alias("key"))
    with settings(spark, **SHUFFLED):
        plan = with_key_stats(df, "key", {"low": F.min("id")})._jdf.queryExecution().executedPlan().toString()
    lines = plan[plan.index("SortMergeJoin"):].splitlines()
    sorts = [i for i, line in enumerate(lines) if "Sort [" in line]
    assert len(sorts) == 2 and all("Exchange hashpartitioning" in lines[i + 1] for i in sorts)


def test_entries_are_counted_without_their_texts(rows):
    raw = rows(case_id=["1", "", "3"], client_name=["Ann  Lee", "Bo", "Ann Lee"], category=["billng", "", "Billing"], priority=["p1", "High", "Critical"],
               status=["RESOLVED", "open", "Closed"], intake_date=["05/14/2024", "2024-05-01", "2024-05-14"], closure_date=["2024-06-01", "", "2024-06-01"],
               triage_date=["", "", ""], triaged=["Yes", "0", "True"], contact_count=["abc", "2", "2"])
    result = clean(raw)
    entries = result.audit().count()
    assert result.summary.first().modifications == entries > 5
    plan = result.summary._jdf.queryExecution().optimizedPlan().toString()
    assert "WHITESPACE_TRIMMING" not in plan and "transformation_rule" not in plan


def test_rows_of_two_alike_groups_are_paired_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(duplicates, "CHUNK_ROWS", 10)
    names = {0: "north sea trading", 1: "north sea tradings", 2: "quite another name"}
    data = [(i, names[i % 3 if i < 120 else 0], "x") for i in range(150)] + [(200, None, "x")]
    df = spark.createDataFrame(data, "row_index long, client_name string, category string")
    edges = duplicates.fuzzy_duplicates(df).withColumn("p", F.spark_partition_id()).collect()
    left, right = [i for i, n, _ in data if n == names[0]], [i for i, n, _ in data if n == names[1]]
    assert sorted((e.index_a, e.index_b) for e in edges) == sorted((min(a, b), max(a, b)) for a in left for b in right)
    assert len({e.p for e in edges}) > 3


def test_only_columns_that_may_be_dates_are_read_as_dates(rows, monkeypatch):
    data = {"when": ["2024-01-02"] * 8, "late": ["2024-01-02"] * 7 + ["soon"], "note": ["soon"] + ["2024-01-02"] * 7, "gone": [""] * 8}
    for look in (1, 1000):  # however many rows are looked at first
        monkeypatch.setattr(profile, "_FIRST_LOOK", look)
        read, parse = [], profile.parse_date
        monkeypatch.setattr(profile, "parse_date", lambda c: read.append(c) or parse(c))
        got = {r.column_name: r.inferred_type for r in profile.column_profile(rows(**data).coalesce(1)).collect()}
        monkeypatch.setattr(profile, "parse_date", parse)
        assert got == {"when": "datetime", "late": "categorical", "note": "categorical", "gone": "empty"}
        assert "when" in read[4:] and "note" not in read[4:]


def _lines(seed=5, rows=600):
    """Levels of two factors, one of them hot, in two segments of which one is NULL."""
    rng = random.Random(seed)
    return [(rng.choice(["u", None]), rng.choice([7, rng.randrange(30)]), rng.randrange(20), rng.randrange(9), rng.random() < 0.5, rng.gauss(5, 2)) for _ in range(rows)]


LINES = "seg string, a long, b long, x int, z boolean, y double"


@pytest.mark.parametrize("by", [[], ["seg"]])
def test_steps_of_the_solver_leave_the_cells_where_they_are(spark, monkeypatch, by):
    plans, step = [], regression._level_sums

    def seen(*given):
        sums = step(*given)
        plans.append(sums._jdf.queryExecution().executedPlan().toString())
        return sums

    monkeypatch.setattr(regression, "_level_sums", seen)
    df = spark.createDataFrame(_lines(), LINES)
    with settings(spark, **SHUFFLED):
        got = regression.factor_regression(df, "y", "a", "b", "x", "z", by, dense_levels=4, max_steps=2).collect()
    assert len(got) == 1 + len(by) and plans
    for plan in plans:  # what stands below InMemoryRelation has run already, before the first step
        exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", plan.split("InMemoryRelation")[0])
        assert len(exchanges) == 1 and not re.search(r"\ba#", exchanges[0])


@pytest.mark.parametrize("by", [[], ["seg"]])
def test_two_factors_are_solved_alike_where_levels_are_shuffled(spark, monkeypatch, by):
    df = spark.createDataFrame([*_lines(), ("u", None, 1, 1, True, 1.0), ("u", 1, 2, 3, None, 1.0)], LINES)
    exact = {r[0] if by else None: r for r in regression.factor_regression(df, "y", "a", "b", "x", "z", by).collect()}
    monkeypatch.setattr(regression, "BROADCAST_LEVELS", 0)
    monkeypatch.setattr(regression, "CELLS_A_TASK", 100)
    got = {r[0] if by else None: r for r in regression.factor_regression(df, "y", "a", "b", "x", "z", by, dense_levels=4).collect()}
    assert got.keys() == exact.keys()
    for g, r in got.items():
        assert (r.n, r.model_df, r.resid_df) == (exact[g].n, exact[g].model_df, exact[g].resid_df)
        assert r.residual < 1e-9 and r.r2 == pytest.approx(exact[g].r2, rel=1e-9)


@pytest.mark.parametrize("sent", [True, False])
def test_connected_parts_of_levels_are_counted_without_shuffling_cells(spark, sent):
    """A path, whose ends are far apart, a star around a high level, and single pairs, under shuffled numbers."""
    rng = random.Random(3)
    path = [(f"p{i}", i + j) for i in range(60) for j in (0, 1)]
    star = [(f"s{i}", b) for i in range(20) for b in (100 + i, 999)]
    data = [(0, a, b) for a, b in path + star + [("x", 500), ("y", 501), ("y", 502)]]
    number = dict(zip(sorted({b for *_, b in data}), rng.sample(range(1000), 200)))
    cells = spark.createDataFrame([(g, a, number[b]) for g, a, b in data], "g int, a string, b long").repartition(3, "a")
    levels = len({a for _, a, _ in data}) + len({b for *_, b in data})
    assert [tuple(r) for r in regression._levels_less_parts(cells, [], sent).collect()] == [(0, levels - 4)]
