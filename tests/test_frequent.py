"""Exact top values without a full shuffle, and profiles that merge."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.operators import frequent, profile, sketches


def best(values: list, limit: int) -> list[tuple]:
    return sorted(Counter(v for v in values if v is not None).items(), key=lambda x: (-x[1], x[0]))[:limit]


def words(kind: str) -> list[str | None]:
    deal = random.Random(11)
    if kind == "steep":
        return [f"w{int(deal.paretovariate(1.0)) % 5000}" for _ in range(20_000)]
    if kind == "flat":
        return [f"w{i % 3000}" for i in range(9_000)]
    if kind == "one":
        return ["same"] * 500
    if kind == "third":
        return ["hot"] * 4_000 + [f"w{i}" for i in range(8_000)]
    return [None, None, "a", "b", "b", ""]


@pytest.mark.parametrize("kind", ["steep", "flat", "one", "third", "few"])
@pytest.mark.parametrize("buckets", [1, 64, 4_096])
def test_top_values_are_exact(spark, kind, buckets):
    """Ties, flat tables and a poor bucketing (one bucket) change the work, not the rows."""
    given = words(kind)
    df = spark.createDataFrame([(v,) for v in given], "value string").repartition(7)
    got = frequent.frequent_values(df, "value", limit=6, buckets=buckets).orderBy("position").collect()
    assert [(r["value"], r["n"]) for r in got] == best(given, 6)
    assert [r["position"] for r in got] == list(range(1, len(got) + 1))


def test_a_missed_candidate_is_found_by_its_bucket(spark, monkeypatch):
    """With a sketch of the least size the likely values are poor; the result is exact all the same."""
    monkeypatch.setattr(frequent, "TRACKED", 1)
    given = words("flat") + ["w17"] * 5
    df = spark.createDataFrame([(v,) for v in given], "value string").repartition(5)
    got = frequent.frequent_values(df, "value", limit=3, buckets=256).orderBy("position").collect()
    assert [(r["value"], r["n"]) for r in got] == best(given, 3)


def test_groups_null_and_clashing_names(spark):
    data = [("a", 1, "x"), ("a", 1, "x"), (None, 2, "y"), (None, 2, "z"), (None, 2, "z"), ("a", 1, None), ("b", 3, None)]
    df = spark.createDataFrame(data, "n string, position int, value string")
    got = frequent.frequent_values(df.withColumnRenamed("n", "kind"), "value", ["kind"], 1).collect()
    assert {(r["kind"], r["value"], r["n"]) for r in got} == {("a", "x", 2), (None, "z", 2)}


def test_many_groups_are_counted_plainly(spark, monkeypatch):
    monkeypatch.setattr(frequent, "MOST_GROUPS", 3)
    df = spark.range(600).select((F.col("id") % 30).alias("g"), (F.col("id") % 7).cast("string").alias("value"))
    want = df.groupBy("g", "value").count().collect()
    by_group: dict = {}
    for r in want:
        by_group.setdefault(r["g"], []).append((-r["count"], r["value"]))
    got = frequent.frequent_values(df, "value", ["g"], 2).collect()
    assert {(r["g"], -r["n"], r["value"]) for r in got} == {(g, *x) for g, found in by_group.items() for x in sorted(found)[:2]}


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "g string, value string")
    assert frequent.frequent_values(empty, "value", ["g"]).count() == 0
    assert sketches.merge_sketches(sketches.sketch_profile(empty, ["g"])).count() == 0


def test_frequent_cells_are_top_values(rows, spark):
    df = rows(a=["x", "y", "x", None, "nan"], b=["1", "2", "3", "2", " "])
    columns = ["column_name", "value", "n", "position"]
    assert sorted(frequent.frequent_cells(df, 2).select(columns).collect()) == sorted(profile.top_values(df, 2).select(columns).collect())


def test_only_values_of_heavy_buckets_are_shuffled(spark):
    """Values counted one by one are a small part of the distinct values when a few lead clearly."""
    given = ["hot"] * 900 + ["warm"] * 700 + [f"w{i}" for i in range(20_000)]
    cells = spark.createDataFrame([(0, v) for v in given], "_group int, _value string").repartition(8)
    assert frequent.candidate_counts(cells, 2, 4_096).count() < 100


def events(spark):
    return spark.range(40_000).select(
        (F.col("id") % 8).cast("string").alias("day"),
        F.col("id").alias("key"),
        (F.col("id") % 1_000).alias("user"),
        F.when(F.col("id") % 4 > 0, "here").alias("place"),
    )


def test_merged_days_agree_with_exact_counts(spark):
    whole = events(spark)
    days = sketches.sketch_profile(whole, ["day"])
    got = {r["column_name"]: r for r in sketches.estimated_profile(sketches.merge_sketches(days)).collect()}
    exact = {"key": 40_000, "user": 1_000, "place": 1}
    assert set(got) == set(exact)
    for name, n in exact.items():
        assert abs(got[name]["unique_estimate"] - n) <= 4 * sketches.standard_error() * n
    assert got["place"]["missing_count"] == 10_000 and got["place"]["missing_percentage"] == 25.0


def test_days_are_added_and_replaced_in_the_stored_table(spark, tmp_path):
    path, whole = str(tmp_path / "sketches"), events(spark)
    sketches.write_sketches(sketches.sketch_profile(whole.where("day < 6"), ["day"]), path, "day")
    sketches.write_sketches(sketches.sketch_profile(whole.where("day >= 5"), ["day"]), path, "day")
    merged = sketches.merge_sketches(spark.read.parquet(path)).collect()
    assert {r["column_name"]: r["total_count"] for r in merged} == {"key": 40_000, "user": 40_000, "place": 40_000}
    at_once = sketches.estimated_profile(sketches.merge_sketches(sketches.sketch_profile(whole, ["day"]))).collect()
    by_parts = sketches.estimated_profile(sketches.merge_sketches(spark.read.parquet(path))).collect()
    assert sorted(at_once) == sorted(by_parts)


def test_sketches_of_different_width_merge(spark):
    whole = events(spark)
    mixed = sketches.sketch_profile(whole.where("day < 4"), lg_k=14).unionByName(sketches.sketch_profile(whole.where("day >= 4"), lg_k=12))
    found = {r["column_name"]: r["unique_estimate"] for r in sketches.estimated_profile(sketches.merge_sketches(mixed)).collect()}
    assert abs(found["key"] - 40_000) <= 4 * sketches.standard_error(12) * 40_000
